"""Order-dependent operators with SQL that follows them step by step: merging, threads, packing, rate limits, moving averages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators import folds
from textloom.operators.labels import stored
from textloom.plans.ranking import _ranges
from textloom.sources import stores


def derived_id(*columns: Column) -> Column:
    """An id in the form of a UUID that follows from its columns: the first 128 bits of their SHA-256."""
    h = F.sha2(F.concat_ws("\u0001", *columns), 256)
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12))


def linked(df: DataFrame, near: float = 0.65, ahead: int = 4) -> DataFrame:
    """(id, thread_id, thread_size, thread_position): threads named by the row that opens them; the only row of a source is single, under a derived id."""
    alone = df.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    rows = df.join(alone, "source")
    threads = folds.link_threads(rows.where("n > 1"), near, ahead).select("id", F.concat(F.lit("thread_"), F.lpad(F.col("thread").cast("string"), F.greatest(F.lit(6), F.length(F.col("thread").cast("string"))), F.lit("0"))).alias("thread_id"))
    single = rows.where("n = 1").select("id", F.concat(F.lit("single_"), F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 12)).alias("thread_id"))
    w = Window.partitionBy("thread_id")
    found = threads.unionByName(single)
    return found.select("id", "thread_id", F.count(F.lit(1)).over(w).alias("thread_size"), F.row_number().over(w.orderBy("id")).cast("long").alias("thread_position"))


def _starts(lengths: np.ndarray, most: int) -> np.ndarray:
    """For each item the first that no longer fits a sequence begun with it."""
    total = np.concatenate([[0], np.cumsum(lengths)])
    end = np.searchsorted(total, total[:-1] + most, side="right") - 1
    return np.maximum(end, np.arange(len(lengths)) + 1)


def pack_in_order(df: DataFrame, most: int = 512) -> DataFrame:
    """(id, pack): items (id, length) in order of id filled into sequences of at most ``most`` tokens; longer ones stand alone. One sequence of packs over the whole table.

    Ranges of the sorted table are packed side by side. For each room (0 to
    ``most``) that the range before may leave, a range says how many packs it adds
    and what room it leaves; these tables are chained on the driver, and a second
    pass numbers the packs.
    """
    rows = stored(_ranges(df.select("id", F.least("length", F.lit(most)).cast("long").alias("length"), (F.col("length") > most).alias("long")), [F.asc("id")], "packing").drop("__at"), "packing-ranges")
    spark = df.sparkSession

    def heads(lengths: np.ndarray, room: int) -> list[int]:
        """Items that open a pack, if the range begins with so much room."""
        after = _starts(lengths, most)
        at = int(np.searchsorted(np.cumsum(lengths), room, side="right"))
        out = []
        while at < len(lengths):
            out.append(at)
            at = int(after[at])
        return out

    def table(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, lengths in _parts(frames):
            after, total = _starts(lengths, most), np.concatenate([[0], np.cumsum(lengths)])
            n = len(lengths)
            packs, left = np.zeros(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
            for i in range(n - 1, -1, -1):
                j = after[i]
                packs[i] = 1 + packs[j]
                left[i] = left[j] if j < n else most - (total[n] - total[i])
            first = np.searchsorted(total[1:], np.arange(most + 1), side="right")
            added = packs[first]
            room = np.where(first < n, left[np.minimum(first, n)], np.arange(most + 1) - total[n])
            yield pd.DataFrame({"part": [part], "added": [added.tolist()], "room": [room.tolist()]})

    def _parts(frames):
        """(part, lengths) of runs of rows of one part, sorted by id."""
        held, now = [], None
        for f in frames:
            for part, group in f.groupby("__part", sort=False):
                if now is not None and part != now:
                    yield now, np.concatenate(held)
                    held = []
                now = part
                held.append(group["length"].to_numpy())
        if now is not None:
            yield now, np.concatenate(held)

    ordered = rows.repartition("__part").sortWithinPartitions("__part", "id")
    chain = sorted(ordered.select("__part", "length").mapInPandas(table, "part long, added array<long>, room array<long>").collect(), key=lambda r: r["part"])  # a row of most + 1 numbers a range
    starts, pack, room = {}, -1, 0
    for r in chain:
        starts[r["part"]] = (pack, room)
        pack, room = pack + r["added"][room], r["room"][room]
    shared = spark.sparkContext.broadcast(starts)

    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, now = [], None

        def out():
            f = pd.concat(held)
            pack, room = shared.value[now]
            lengths = f["length"].to_numpy()
            opens = np.zeros(len(f), dtype=np.int64)
            opens[heads(lengths, room)] = 1
            return pd.DataFrame({"id": f["id"].to_numpy(), "pack": pack + np.cumsum(opens)})

        for f in frames:
            for part, group in f.groupby("__part", sort=False):
                if now is not None and part != now:
                    yield out()
                    held = []
                now = part
                held.append(group)
        if held:
            yield out()

    return ordered.select("__part", "id", "length").mapInPandas(number, "id long, pack long")


def _vectors(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr("label AS source", "vec_id AS id", "embedding", "100L AS length")


def w3_merge(spark, sf_dir):
    """Neighbours of a label at 0.3 or more: the tables hold nothing at the default of 0.7."""
    return folds.merge_consecutive(_vectors(spark, sf_dir), near=0.3)


def w5_threads(spark, sf_dir):
    """At 0.3 in place of 0.65; vector 0 is a source of its own."""
    rows = _vectors(spark, sf_dir).withColumn("source", F.when(F.col("id") == 0, -1).otherwise(F.col("source")))
    return linked(rows, near=0.3)


def a6_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"(?U)\s+"), lambda w: w != ""))
    return pack_in_order(docs.select(F.col("doc_id").alias("id"), n.cast("long").alias("length")))


def x5_rate(spark, sf_dir):
    """With three tokens in place of 100, as events lie minutes apart."""
    return folds.limit_rate(spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("user_id AS user", "event_id AS id", "unix_micros(CAST(ts AS TIMESTAMP)) DIV 1000 AS us"), cap=3)


def x9_average(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("user_id AS name", "event_id AS id", "value / 1000 AS reward", "event_id AS seen")
    return stores.reputations(rows).select("name", "n", F.round("ema_reward", 6).alias("ema"))


def x_ids(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", derived_id(F.col("source"), F.col("doc_id").cast("string")).alias("id"))


def x_maps(spark, sf_dir):
    """Maps of a document: a value with a default, two merged (the later wins), one with an entry put in, the keys left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = F.map_from_arrays(F.array(F.lit("lang"), F.lit("kind")), F.array("lang", F.lit("pdf")))
    second = F.map_from_arrays(F.array(F.lit("source"), F.lit("kind")), F.array("source", F.lit("doc")))
    merged = F.map_concat(F.map_filter(first, lambda k, v: ~F.array_contains(F.map_keys(second), k)), second)
    put = F.map_concat(F.map_filter(merged, lambda k, v: k != "n"), F.create_map(F.lit("n"), F.col("n_chars").cast("string")))
    told = F.array_join(F.array_sort(F.transform(F.map_entries(put), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    return docs.select("doc_id", F.coalesce(F.try_element_at(first, F.lit("author")), F.lit("unknown")).alias("author"), told.alias("entries"), F.array_join(F.array_sort(F.map_keys(merged)), ",").alias("keys"))


def x_strings(spark, sf_dir):
    """Starts, ends, cases, letters, last words and the last sentence end of a text."""
    t = F.col("text")
    w = F.filter(F.split(t, r"(?U)\s+"), lambda x: x != "")
    letters = F.regexp_replace(t, r"[^\p{L}]", "")
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", t.startswith("The").alias("starts"), (t.endswith(".") | t.endswith("!")).alias("ends"), ((F.upper(t) == t) & (F.lower(t) != t)).alias("is_upper"), ((F.lower(t) == t) & (F.upper(t) != t)).alias("is_lower"),
        ((F.length(letters) == F.length(t)) & (F.length(t) > 0)).alias("is_alpha"), F.array_join(F.slice(w, F.greatest(F.size(w) - 2, F.lit(1)), 3), " ").alias("last_words"), (F.length(t) - F.instr(F.reverse(t), " .")).alias("last_end"),
    )


QUERIES = {"W3_merge": w3_merge, "W5_threads": w5_threads, "A6_packing": a6_packing, "X5_rate_limit": x5_rate, "X9_moving_average": x9_average, "X_ids": x_ids, "X_maps": x_maps, "X_strings": x_strings}

_EMB = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"
_UNIT = f"list_transform({_EMB}, lambda x: x / sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))))"
ORACLE_SQL = {
    "W3_merge": f"""WITH RECURSIVE o AS (SELECT label AS source, vec_id AS id, {_UNIT} AS v, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS i FROM embeddings),
s AS (SELECT source, i, 0 AS part, id AS first_id, 1 AS n, 100 AS length, v AS total FROM o WHERE i = 1 UNION ALL
 SELECT source, i, CASE WHEN fits THEN part ELSE part + 1 END, CASE WHEN fits THEN first_id ELSE id END, CASE WHEN fits THEN n + 1 ELSE 1 END, CASE WHEN fits THEN length + 100 ELSE 100 END, CASE WHEN fits THEN list_transform(list_zip(total, v), lambda z: z[1] + z[2]) ELSE v END
 FROM (SELECT o.source, o.i, o.id, o.v, s.part, s.first_id, s.n, s.length, s.total, s.length + 100 <= 2000 AND round(list_inner_product(s.total, o.v) / sqrt(list_inner_product(s.total, s.total)), 9) >= 0.3 AS fits FROM s JOIN o ON o.source = s.source AND o.i = s.i + 1) z)
SELECT source, CAST(part AS BIGINT) AS part, first_id, CAST(max(n) AS BIGINT) AS merged_from, CAST(max(length) AS BIGINT) AS length FROM s GROUP BY source, part, first_id""",
    "W5_threads": f"""WITH RECURSIVE e AS (SELECT CASE WHEN vec_id = 0 THEN -1 ELSE label END AS source, vec_id AS id, {_UNIT} AS v FROM embeddings), o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY id) AS i, count(*) OVER (PARTITION BY source) AS n FROM e),
near AS (SELECT a.source, a.i, list(b.i - a.i) AS js FROM o a JOIN o b ON a.source = b.source AND b.i > a.i AND b.i <= a.i + 4 WHERE round(list_inner_product(a.v, b.v), 9) >= 0.3 GROUP BY a.source, a.i),
k AS (SELECT o.source, o.id, o.i, coalesce(near.js, []) AS js FROM o LEFT JOIN near ON near.source = o.source AND near.i = o.i WHERE o.n > 1),
s AS (SELECT source, i, id AS thread, list_transform([1, 2, 3, 4], lambda j: CASE WHEN list_contains(js, j) THEN id END) AS held FROM k WHERE i = 1 UNION ALL
 SELECT source, i, coalesce(own, id), CASE WHEN own IS NOT NULL THEN rest ELSE list_transform([1, 2, 3, 4], lambda j: CASE WHEN rest[j] IS NOT NULL THEN rest[j] WHEN list_contains(js, j) THEN id END) END
 FROM (SELECT k.source, k.i, k.id, k.js, s.held[1] AS own, [s.held[2], s.held[3], s.held[4], NULL] AS rest FROM s JOIN k ON k.source = s.source AND k.i = s.i + 1) z),
t AS (SELECT k.id, 'thread_' || lpad(CAST(s.thread AS VARCHAR), CAST(greatest(6, length(CAST(s.thread AS VARCHAR))) AS INT), '0') AS thread_id FROM s JOIN k ON k.source = s.source AND k.i = s.i UNION ALL SELECT id, 'single_' || substr(sha256(CAST(id AS VARCHAR)), 1, 12) FROM o WHERE n = 1)
SELECT id, thread_id, count(*) OVER (PARTITION BY thread_id) AS thread_size, row_number() OVER (PARTITION BY thread_id ORDER BY id) AS thread_position FROM t""",
    "A6_packing": r"""WITH RECURSIVE o AS (SELECT doc_id AS id, least(len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')), 512) AS n, row_number() OVER (ORDER BY doc_id) AS i FROM documents),
s AS (SELECT i, id, CAST(0 AS BIGINT) AS pack, 512 - n AS room FROM o WHERE i = 1 UNION ALL SELECT o.i, o.id, CASE WHEN o.n <= s.room THEN s.pack ELSE s.pack + 1 END, CASE WHEN o.n <= s.room THEN s.room - o.n ELSE 512 - o.n END FROM s JOIN o ON o.i = s.i + 1)
SELECT id, pack FROM s""",
    "X5_rate_limit": """WITH RECURSIVE o AS (SELECT user_id, event_id AS id, epoch_us(ts) // 1000 AS us, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS i FROM events),
s AS (SELECT user_id, i, id, us, true AS allowed, 2e0 AS held FROM o WHERE i = 1 UNION ALL SELECT user_id, i, id, us, h >= 1, CASE WHEN h >= 1 THEN h - 1 ELSE h END FROM (SELECT o.user_id, o.i, o.id, o.us, least(3e0, s.held + (o.us - s.us) / 1e6) AS h FROM s JOIN o ON o.user_id = s.user_id AND o.i = s.i + 1) z)
SELECT id, allowed FROM s""",
    "X9_moving_average": """WITH RECURSIVE o AS (SELECT user_id AS name, value / 1000 AS r, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events),
s AS (SELECT name, i, n, 0.5e0 + 0.1e0 * (r - 0.5e0) AS ema FROM o WHERE i = 1 UNION ALL SELECT o.name, o.i, o.n, s.ema + 0.1e0 * (o.r - s.ema) FROM s JOIN o ON o.name = s.name AND o.i = s.i + 1) SELECT name, n, round(ema, 6) AS ema FROM s WHERE i = n""",
    "X_ids": "SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS id FROM (SELECT doc_id, sha256(source || chr(1) || doc_id) AS h FROM documents) z",
    "X_maps": "SELECT doc_id, 'unknown' AS author, 'kind=doc,lang=' || lang || ',n=' || n_chars || ',source=' || source AS entries, 'kind,lang,source' AS keys FROM documents",
    "X_strings": r"""SELECT doc_id, starts_with(text, 'The') AS starts, ends_with(text, '.') OR ends_with(text, '!') AS ends, upper(text) = text AND lower(text) <> text AS is_upper, lower(text) = text AND upper(text) <> text AS is_lower, regexp_full_match(text, '\p{L}+') AS is_alpha,
 array_to_string(list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')[-3:], ' ') AS last_words, CAST(length(text) - strpos(reverse(text), ' .') AS INT) AS last_end FROM documents""",
}
