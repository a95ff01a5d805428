"""K-d tree sharding: nodes are split at distributed weighted medians along their widest metadata dimension.

Documents with equal texts form a group that is never split. A node that must
make n leaves is cut at the weighted quantile floor(n/2)/n of its bytes, along
the dimension with the largest extent (relative to the whole table's); ties in
that dimension are ordered by a hash of the text, so cuts are exact up to one
group. Quantiles come from histograms that are refined until a bin holds one
key; the driver sees at most MAX_BINS bins a pass, whatever the data.

Null texts count as empty, null languages or sources as ''. Repeated rows stay
rows of their own. An empty table gives no rows. Extra columns are ignored; an id column named
like one of the result's is not allowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import load, small_table, written

MAX_BINS = 1 << 17
#: Rows of one numbering task.
SLOT_ROWS = 20_000
DIMS = ("size", "source_key", "lang_key", "text_crc32")


def _median_cuts(groups: DataFrame, wanted: dict[int, tuple[str, float]]) -> dict[int, int]:
    """For each node (dimension, target bytes): the largest key of the left half. The driver sees MAX_BINS bins a pass, or 16 a node where nodes are more."""
    spark = groups.sparkSession
    lo = {n: (0, (1 << 63) - 1, 0.0) for n in wanted}  # node -> (from, to, bytes before)
    cuts: dict[int, int] = {}
    while len(cuts) < len(wanted):
        open_ = [n for n in wanted if n not in cuts]
        bins = max(16, MAX_BINS // len(open_))
        plan = small_table(spark, [(n, DIMS.index(wanted[n][0]), lo[n][0], lo[n][1], max(1, -(-(lo[n][1] - lo[n][0] + 1) // bins))) for n in open_], "node int, dim int, lo long, hi long, step long")
        found = (
            groups.join(F.broadcast(plan), "node")
            .withColumn("k", _key(F.col("dim")))
            .where("k BETWEEN lo AND hi")
            .groupBy("node", F.expr("(k - lo) div step").alias("bin"))
            .agg(F.sum("w").alias("w"), F.min("k").alias("a"), F.max("k").alias("b"))
            .collect()
        )
        by_node: dict[int, list] = {}
        for r in sorted(found, key=lambda r: (r["node"], r["bin"])):
            by_node.setdefault(r["node"], []).append(r)
        for n in open_:
            before, mine = lo[n][2], by_node[n]
            last = None
            for r in mine:
                if before + r["w"] >= wanted[n][1] or r is mine[-1]:
                    break
                before, last = before + r["w"], r
            if r["a"] == r["b"]:  # one key: it goes where the halves come out nearer
                under, over = wanted[n][1] - before, before + r["w"] - wanted[n][1]
                cuts[n] = r["a"] - 1 if under < over and (last is not None or before > 0) else r["a"]
            else:
                lo[n] = (r["a"], r["b"], before)
    return cuts


def _key(dim):
    """Order along a dimension (0 .. 2^32 - 1), ties by 31 bits of the text's hash."""
    value = F.coalesce(*[F.when(dim == i, F.least(F.col(d), F.lit((1 << 32) - 1))) for i, d in enumerate(DIMS)])
    return F.shiftleft(value, 31).bitwiseOR(F.shiftrightunsigned("h", 33))


def kd_shards(df: DataFrame, n_shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row; ``n_shards`` leaves, or as many as ``target_bytes`` asks for."""
    if id_col.lower() in ("size", "text_crc32", "shard", "slot"):
        raise ValueError(f"the id column cannot be named {id_col}: rename it")
    text_of = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    blank = lambda c: F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")) if c in df.columns else F.lit(0).cast("long")
    rows = written(
        df.select(F.col(f"`{id_col}`").alias("id"), (F.octet_length(text_of) + F.lit(1)).cast("long").alias("size"), F.crc32(text_of).alias("text_crc32"), F.xxhash64(text_of).alias("h"), blank("source").alias("source_key"), blank("lang").alias("lang_key")),
        "kd-rows",
    )
    groups = rows.groupBy("h", "text_crc32", "size").agg(F.sum("size").alias("w"), F.min("source_key").alias("source_key"), F.min("lang_key").alias("lang_key")).withColumn("node", F.lit(0))
    groups = written(groups, "kd-groups")
    spark = df.sparkSession
    whole = groups.agg(F.coalesce(F.sum("w"), F.lit(0)).alias("w"), *[F.coalesce(F.max(d) - F.min(d), F.lit(0)).alias(d) for d in DIMS]).first()
    leaves = {0: n_shards or max(1, -(-whole["w"] // target_bytes))}
    first = {0: 0}  # node -> its first shard
    while any(n > 1 for n in leaves.values()):
        spans = {r["node"]: r for r in groups.groupBy("node").agg(F.sum("w").alias("w"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMS]).collect()}
        wide = lambda r: max(DIMS, key=lambda d: r[d] / max(whole[d], 1))
        wanted = {n: (wide(spans[n]), spans[n]["w"] * (leaves[n] // 2) / leaves[n]) for n in leaves if leaves[n] > 1 and n in spans}
        if not wanted:
            break
        cuts = _median_cuts(groups, wanted)
        top = max(leaves) + 1
        plan, grown, starts = [], {n: k for n, k in leaves.items() if n not in wanted}, dict(first)
        for i, (n, (dim, _)) in enumerate(wanted.items()):
            right = top + i
            grown[n], grown[right] = leaves[n] // 2, leaves[n] - leaves[n] // 2
            starts[right] = first[n] + leaves[n] // 2
            plan.append((n, DIMS.index(dim), cuts[n], right))
        cut = F.broadcast(small_table(spark, plan, "node int, dim int, cut long, right int"))
        groups = written(
            groups.join(cut, "node", "left").withColumn("node", F.when(F.col("cut").isNotNull() & (_key(F.col("dim")) > F.col("cut")), F.col("right")).otherwise(F.col("node"))).drop("dim", "cut", "right"),
            "kd-groups",
        )
        leaves, first = grown, starts
    names = F.broadcast(small_table(spark, sorted(first.items()), "node int, shard int"))
    placed = rows.join(groups.join(names, "node").select("h", "text_crc32", "size", "shard"), ["h", "text_crc32", "size"]).select("id", "size", "text_crc32", "h", "shard")
    return numbered(placed, "id", rows.count()).withColumnRenamed("id", id_col)


def numbered(placed: DataFrame, id_col: str, n_rows: int) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard, without gathering a shard in one task: rows are numbered in hash buckets of bounded size."""
    from pyspark.sql import Window

    buckets = max(1, -(-n_rows // SLOT_ROWS))
    placed = written(placed.withColumn("bucket", F.pmod(F.xxhash64(id_col, F.lit(7)), F.lit(buckets)).cast("int")), "kd-placed")
    sizes = placed.groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    order = Window.partitionBy("shard", "bucket").orderBy(id_col, "text_crc32", "h")
    return placed.withColumn("at", F.row_number().over(order)).join(offsets, ["shard", "bucket"]).select(id_col, "size", "text_crc32", "shard", (F.col("offset") + F.col("at") - 1).alias("slot"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 7 of near equal bytes; equal texts share a shard."""
    placed = kd_shards(load(spark, sf_dir, "documents"), n_shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
