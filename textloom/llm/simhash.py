"""SimHash near-duplicates: pigeonhole blocks, join on blocks, verified Hamming distance, connected components.

Equal fingerprints are one class before anything is
joined, so copies cost nothing. A class emits one key for each choice of
blocks; classes that share a key are compared inside it, and each key yields
the edges of a spanning forest of its close pairs, nearest first, never all
pairs. Keys with more classes than CELL are dealt out as pairs of hash slices,
so that no task holds more than two slices.

With ``blocks`` blocks of which ``shared`` must agree, all pairs at up to
``blocks - shared`` differing bits are found (pigeonhole principle). The stage of
the pipeline takes near copies from these groups, checked by the Jaccard similarity
of word shingles; those whose fingerprints are further apart are found by a join on
shingles (``jaccard.py``), so that none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import arrow_stage, fold_words, load, texts, written
from textloom.llm.components import components
from textloom.llm.jaccard import similar_groups

#: Classes of one key that one task compares at once.
CELL = 4096
#: Shingles whose bits are added up at once.
CHUNK = 1 << 15


@dataclass(frozen=True)
class Plan:
    """bits: length of the fingerprint. A key is made of ``shared`` of ``blocks`` equal blocks; pairs link at ``distance`` or fewer bits."""

    shingle: int = 3
    bits: int = 64
    blocks: int = 6
    shared: int = 3
    distance: int = 3

    def keys(self) -> list[list[tuple[int, int]]]:
        """For each choice of blocks its bit ranges, bit 0 the highest."""
        edge = [round(i * self.bits / self.blocks) for i in range(self.blocks + 1)]
        return [[(edge[i], edge[i + 1]) for i in c] for c in combinations(range(self.blocks), self.shared)]


#: Links at 3 of 64 bits: of 6 blocks, 3 are equal in every such pair; 20 keys of about 32 bits.
EXACT = Plan()


def simhash(words: list[bytes], shingle: int, bits: int) -> bytes:
    """Big-endian fingerprint: a bit is 1 if more than half of the shingles' XXH64 (seed 42; beyond 64 bits, of words mixed from it) have it. No words: zero."""
    if not words:
        return bytes(bits // 8)
    line = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        starts, at = [], 0
        for w in words:
            starts.append(at)
            at += len(w) + 1
        digest = xxhash.xxh64_intdigest
        ends = [*starts[shingle:], at]
        hashes = [digest(line[a : b - 1], 42) for a, b in zip(starts, ends, strict=False)]
    h = np.array(hashes, dtype=np.uint64)
    ones = np.zeros(bits, dtype=np.int64)
    for at in range(0, len(h), CHUNK):
        part = h[at : at + CHUNK]
        for k in range(bits // 64):
            x = part
            if k:
                with np.errstate(over="ignore"):
                    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
                    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD1B54A32D192ED03)
                    x ^= x >> np.uint64(29)
            ones[64 * k : 64 * k + 64] += np.unpackbits(x.byteswap().view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * ones > len(h)).tobytes()


def _spanning(fp: np.ndarray, limit: int) -> list[tuple[int, int, int]]:
    """Edges (i, j, distance) of a minimum spanning forest of the pairs at up to ``limit`` bits. Prim: memory linear in the rows."""
    n = len(fp)
    best, parent, out = np.full(n, 1 << 30), np.zeros(n, dtype=np.int64), []
    todo = np.arange(n)
    at = 0
    while len(todo) > 1:
        keep = todo != at
        todo = todo[keep]
        d = np.bitwise_count(fp[todo] ^ fp[at]).sum(axis=1)
        closer = d < best[todo]
        rows = todo[closer]
        best[rows], parent[rows] = d[closer], at
        at = todo[np.argmin(best[todo])]
        if best[at] <= limit:
            out.append((int(parent[at]), int(at), int(best[at])))
        # beyond the limit a new tree begins at this row
    return out


def _links(nodes: np.ndarray, fps: np.ndarray, first: np.ndarray, limit: int) -> list[tuple[bytes, bytes, int]]:
    """Forest edges within the groups that begin at ``first``."""
    out = []
    sizes = np.diff(np.append(first, len(nodes)))
    pairs = first[sizes == 2]  # most groups: compared all at once
    d = np.bitwise_count(fps[pairs] ^ fps[pairs + 1]).sum(axis=1)
    out += [(nodes[i], nodes[i + 1], int(x)) for i, x in zip(pairs[d <= limit], d[d <= limit], strict=True)]
    for s, n in zip(first[sizes > 2], sizes[sizes > 2], strict=True):
        out += [(nodes[s + i], nodes[s + j], x) for i, j, x in _spanning(fps[s : s + n], limit)]
    return out


EDGE = "a binary, b binary, d int"


def close_pairs(classes: DataFrame, plan: Plan) -> DataFrame:
    """Edges (a, b, d) between classes (node, fp) that link; within each key only those of a spanning forest."""
    keys, width = plan.keys(), plan.bits // 8

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                b = batch.slice(at, 8192)
                bits = np.unpackbits(np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=np.uint8).reshape(-1, width), axis=1)
                for k, ranges in enumerate(keys):
                    part = np.concatenate([bits[:, i:j] for i, j in ranges], axis=1)
                    value = np.zeros(len(part), dtype=np.int64)
                    for c in range(part.shape[1]):
                        value = (value << 1) | part[:, c]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), k, dtype=np.int32)), pa.array(value), b.column(0), b.column(1)], names=["band", "key", "node", "fp"])

    rows = classes.select("node", "fp").mapInArrow(emit, "band int, key long, node binary, fp binary")
    # A slice numbers a part of a large key; every pair of slices meets in one cell.
    large = written(rows.groupBy("band", "key").count().where(F.col("count") > CELL).select("band", "key", F.ceil(F.col("count") / CELL).cast("int").alias("m")), "simhash-large")
    rows = rows.join(large, ["band", "key"], "left").withColumn("m", F.coalesce("m", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("m")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("m") - 1))
    rows = rows.withColumn("own", own).withColumn("other", other).select("band", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "node", "fp")
    n = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    cells = rows.repartition(n, "band", "key", "lo", "hi").sortWithinPartitions("band", "key", "lo", "hi")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def work(table, last: bool):
            cols = [table.column(i).to_numpy() for i in range(4)]
            change = np.zeros(table.num_rows, dtype=bool)
            change[:1] = True
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            first = np.flatnonzero(change)
            cut = table.num_rows if last else first[-1]
            rest = None if last else table.slice(cut)
            head, first = table.slice(0, cut), first[first < cut]
            shared = np.diff(np.append(first, cut)) > 1
            if not shared.any():
                return [], rest
            take = np.repeat(shared, np.diff(np.append(first, cut)))
            sizes = np.diff(np.append(first, cut))[shared]
            head = head.filter(pa.array(take))
            nodes = np.array(head.column(4).to_pylist(), dtype=object)
            fps = np.frombuffer(b"".join(head.column(5).to_pylist()), dtype=np.uint64).reshape(-1, width // 8)
            return _links(nodes, fps, np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64), plan.distance), rest

        def batch_of(edges):
            a, b, d = zip(*((x, y, d) if x < y else (y, x, d) for x, y, d in edges), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(d, pa.int32())], names=["a", "b", "d"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table.cast(held.schema)]).combine_chunks()
            edges, held = work(table, False)
            if edges:
                yield batch_of(edges)
        if held is not None and held.num_rows:
            edges, _ = work(held, True)
            if edges:
                yield batch_of(edges)

    return cells.mapInArrow(compare, EDGE).groupBy("a", "b").agg(F.min("d").alias("d"))


CLASS = T.StructType([T.StructField("class", T.BinaryType()), T.StructField("fp", T.BinaryType())])


def fingerprints(df: DataFrame, plan: Plan, text: str, keep: list[str]) -> DataFrame:
    """Adds ``fp`` and ``class``: the fingerprint itself."""

    def fn(cols):
        fps = [simhash(t.lower().split(), plan.shingle, plan.bits) for t in texts(cols["text"])]
        return [pa.array(fps, pa.binary()), pa.array(fps, pa.binary())]

    return arrow_stage(df, {"text": text}, CLASS, fn, keep)


def near_duplicates(df: DataFrame, plan: Plan = EXACT, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of df: id, fp, component (smallest id of the group). The id column cannot be named fp or component.

    Null texts count as empty, and texts without words link like any others.
    Null ids are grouped like others but are never the smallest id unless a
    group has no other. Rows that repeat an id are told apart by their class. An
    empty table gives no rows. Extra columns are ignored.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    docs = written(fingerprints(rows, plan, "text", ["id"]), "simhash-docs")
    nodes = written(docs.groupBy(F.col("class").alias("node")).agg(F.min("id").alias("rep"), F.min("fp").alias("fp")), "simhash-nodes")
    edges = close_pairs(nodes, plan)
    roots = written(components(edges), "simhash-roots")
    placed = nodes.select("node", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy("root").agg(F.min("rep").alias("component"))
    placed = placed.join(smallest, "root").select(F.col("node").alias("class"), "component")
    return docs.join(placed, "class").select(F.col("id").alias(id_col), "fp", "component")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's 64-bit fingerprint and its component under links of 3 or fewer bits."""
    found = near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of near copies (Jaccard of five-word shingles 0.8 or more) stays: the one with the smallest id.

    Texts of a SimHash component are compared with its first, exactly; near copies that
    this leaves apart are found by their shingles.
    Null ids come after all others. Of rows that repeat both id and text, the
    one with the smallest hash of its columns stays, once. Texts without words
    are copies of each other. An empty table gives no rows. Extra columns stay,
    whatever their names.
    """
    # The row travels as one struct, so that no column's name can clash.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    folded = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = F.md5(F.trim(F.regexp_replace(folded, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")))
    first = F.struct(F.col(f"`{id_col}`").isNull().alias("null"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("hash"))
    distinct = docs.select(row.alias("row"), key.alias("class"), first.alias("first")).groupBy("class").agg(F.min_by("row", "first").alias("row"), F.min("first").alias("first"))
    distinct = written(distinct.select("row", "first", F.monotonically_increasing_id().alias("node")), "near-texts")
    rows = distinct.select("node", F.col("row").getField(text).alias("text"))
    close = near_duplicates(rows, id_col="node").where("node <> component").select(F.array("component", "node").alias("members"))
    grouped = written(similar_groups(rows, candidates=close), "near-groups")
    members = distinct.select("node", "first").join(grouped, "node")
    kept = members.groupBy("root").agg(F.min_by("node", F.struct("first", "node")).alias("kept"))
    # Written, as the size of a small table spares the texts a shuffle.
    dropped = written(grouped.join(kept, "root").where("node <> kept").select("node"), "near-dropped")
    return distinct.join(dropped, "node", "left_anti").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
