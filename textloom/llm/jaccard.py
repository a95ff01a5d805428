"""Texts whose sets of word shingles have a Jaccard similarity of at least ``similarity``: every such pair's connection, exactly.

Prefix filter: shingles are put in one order for all texts, rare ones first. Of
n shingles, a text's first n - ceil(similarity * n) + 1 are its prefix; two
texts that are similar enough have their first common shingle in both prefixes.
So texts are joined on prefix shingles, and no pair can be missed, whatever the
edit (words, blocks, cuts, repeated lines). Rareness comes from counts in
BUCKETS hash buckets; it decides the work, never the result.

Two bounds drop pairs before texts are compared, neither a pair that counts:
what follows the shared shingle in both must hold the common shingles that are
needed; and the parity bitmaps of the sets (256 bits) differ in at most as many
bits as the sets differ in shingles. What is left is compared shingle by shingle.

Large groups: each prefix shingle's first and last text are compared with its
others first. Texts found connected so are not compared with each other again.
Of the rest, a shingle's texts are gathered into clusters (connected by the two
bounds; rows, not pairs), and equal clusters of different shingles are one. A
closer bound, by counts in SKETCH buckets, splits them before sets are moved.
What remains is compared by an inverted index of its shingles, which gives at most as
many links as it has texts. Shingles with more than CELL texts and clusters
with more than CELL_SHINGLES shingles are dealt out as pairs of hash slices.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import arrow_stage, fold_words, texts, texts_by_few, whole_groups, written
from textloom.llm.components import components

#: Hash buckets in which shingles are counted, and those of one row of counts.
BUCKETS, PART = 1 << 18, 1 << 12
#: Prefix rows that are put out at once.
ROWS = 1 << 17
#: Texts of a slice of a shingle, and shingles of a slice of a cluster; a task compares two slices at once.
CELL, CELL_SHINGLES = 4096, 1 << 20
#: Buckets of the closer bound.
SKETCH = 1024
#: A bucket with more shingles than this may hold one that is too frequent for the rows of one task.
HOT = 1 << 22


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles, sorted; fewer words: of the whole sequence; none: empty."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    one = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
    n = max(1, len(words) - size + 1)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(min(size, len(words))):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + one[k : k + n]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD1B54A32D192ED03)
    return np.unique(h ^ (h >> np.uint64(29)))


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - (BUCKETS - 1).bit_length())).astype(np.int64)


def counts(rows: DataFrame, size: int) -> np.ndarray:
    """How many shingles of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for few in texts_by_few(batch.column(0)):
                found = [shingle_hashes(fold_words(t), size) for t in few]
                n += np.bincount(_bucket(np.concatenate(found)), minlength=BUCKETS)
        if n.any():
            parts = [x.tobytes() for x in n.astype("<i8").reshape(-1, PART)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names=["part", "n"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, dtype="<i8") for x in table.column("n").to_pylist())
        return pa.table({"part": table.column("part").slice(0, 1), "n": pa.array([total.tobytes()], pa.binary())})

    found = rows.select("text").mapInArrow(count, "part int, n binary").groupBy("part").applyInArrow(add, "part int, n binary").collect()  # BUCKETS numbers at most
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in found:
        out[r["part"] * PART : (r["part"] + 1) * PART] = np.frombuffer(r["n"], dtype="<i8")
    return out


PREFIX = "token long, node long, size int, pos int, bits binary"


def prefixes(rows: DataFrame, size: int, similarity: float, seen: np.ndarray) -> DataFrame:
    """For each text (node, text) the rows of its prefix: shingle, number of shingles, place in the order, and in the first row the parity bitmap."""
    shared = rows.sparkSession.sparkContext.broadcast(seen)  # BUCKETS numbers

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held = shared.value, []

        def out():
            n = [len(t) for _, t, _, _ in held]
            cols = [np.concatenate([t for _, t, _, _ in held]).view(np.int64), np.repeat([v for v, _, _, _ in held], n)]
            cols += [np.repeat([s for _, _, s, _ in held], n).astype(np.int32), np.concatenate([np.arange(x, dtype=np.int32) for x in n])]
            bits = [x for _, t, _, b in held for x in (b, *[None] * (len(t) - 1))]
            return pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(bits, pa.binary())], names=["token", "node", "size", "pos", "bits"])

        waiting = 0
        for batch in batches:
            for node, t in zip(batch.column(0).to_pylist(), chain.from_iterable(texts_by_few(batch.column(1))), strict=True):
                s = shingle_hashes(fold_words(t), size)
                if not len(s):
                    continue
                first = len(s) - math.ceil(similarity * len(s) - 1e-9) + 1
                bits = np.packbits((np.bincount((s & np.uint64(255)).astype(np.int64), minlength=256) & 1).astype(np.uint8)).tobytes()
                held.append((node, s[np.lexsort((s, seen[_bucket(s)]))[:first]], len(s), bits))
                waiting += first
                if waiting >= ROWS:
                    yield out()
                    held, waiting = [], 0
        if held:
            yield out()

    return rows.select("node", "text").mapInArrow(emit, PREFIX)


def _possible(size, rest, bits, size_at, rest_at, bits_at, similarity: float) -> np.ndarray:
    """Which texts share enough with another, as far as sizes, places and bitmaps tell. Places are those of one shared shingle."""
    both = size + size_at
    apart = np.bitwise_count(bits ^ bits_at).sum(axis=1, dtype=np.int64)
    return (np.minimum(rest, rest_at) * (1 + similarity) >= both * similarity - 1e-6) & (apart * (1 + similarity) <= both * (1 - similarity) + 1e-6)


def connected(node, root, own, near) -> list[tuple[list[int]]]:
    """Sorted sets of two or more nodes that are connected by pairs of different roots (and of different ``own``, if given) that may be similar: near(at, others)."""
    if (root == root[0]).all():
        return []
    todo, out = np.ones(len(node), dtype=bool), []
    while todo.any():
        open_, group = [int(todo.argmax())], []
        todo[open_[0]] = False
        while open_:
            at = open_.pop()
            group.append(at)
            others = np.flatnonzero(todo & (root != root[at]) & (True if own is None else own != own[at]))
            if len(others):
                found = others[near(at, others)]
                todo[found] = False
                open_ += found.tolist()
        if len(group) > 1:
            out.append((np.sort(node[group]).tolist(),))
    return out


def _dealt(rows: DataFrame, keys: list[str], slices: DataFrame) -> DataFrame:
    """Rows dealt to (*keys, lo, hi): of ``m`` slices (given by ``slices`` where above 1) every two meet in one cell; ``own`` is the row's slice."""
    rows = rows.join(slices, keys, "left").withColumn("m", F.coalesce("m", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("m")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    return rows.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("other", "m")


def _cells(rows: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """fn(table of one cell) for each cell of rows that begin with (*keys, lo, hi)."""
    cell = [*keys, "lo", "hi"]
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = None
        for table, first in whole_groups(batches, len(cell)):
            made = [x for a, b in zip(first, [*first[1:], table.num_rows], strict=True) if b - a > 1 for x in fn(table.slice(a, b - a))]
            if made:
                names = names or [x.split()[0] for x in schema.split(", ")]
                yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in made])

    # By hash: a cell is bounded, and there are many.
    return rows.repartition(n, *cell).sortWithinPartitions(*cell).mapInArrow(run, schema)


def clusters(found: DataFrame, similarity: float) -> DataFrame:
    """Of the texts of each shingle (token, node, root, size, pos, bits): sets of those that may be connected by links between different roots (members)."""
    large = written(found.groupBy("token").count().where(F.col("count") > CELL).select("token", F.ceil(F.col("count") / CELL).cast("int").alias("m")), "jaccard-large")
    rows = _dealt(found, ["token"], large).select("token", "lo", "hi", "own", "node", "root", "size", "pos", "bits")

    def gather(t: pa.Table) -> list[tuple[list[int]]]:
        lo, hi, own, node, root, size, pos = (t.column(i).to_numpy() for i in range(1, 8))
        bits = np.frombuffer(b"".join(t.column(8).to_pylist()), dtype=np.uint64).reshape(len(node), -1)
        size, rest = size.astype(np.int64), (size - pos).astype(np.int64)
        return connected(node, root, own if lo[0] != hi[0] else None, lambda at, others: _possible(size[others], rest[others], bits[others], size[at], rest[at], bits[at], similarity))

    return _cells(rows, ["token"], gather, "members array<long>").distinct()


def compare(nodes: np.ndarray, roots: np.ndarray, own: np.ndarray | None, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links between sorted sets that connect all that are similar, given those that share a root are connected already.

    own: only pairs of different ``own`` are compared.
    """
    size = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return [(int(nodes[0]), int(nodes[1]))] if both and both + 1e-9 >= similarity * (size.sum() - both) else []
    # Inverted index: at[first[x] : first[x] + n[x]] are the sets that hold shingle x.
    _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.repeat(np.arange(len(sets)), size)[np.argsort(shingle, kind="stable")]
    n = np.bincount(shingle)
    first, begin = np.cumsum(n) - n, np.cumsum(size) - size
    label = np.unique(roots, return_inverse=True)[1]
    out = []
    # Pairs within the largest group need no comparison, and all others are met from their other end.
    for i in np.flatnonzero(label != np.bincount(label).argmax()):
        x = shingle[begin[i] : begin[i] + size[i]]
        ends = np.cumsum(n[x])
        both = np.bincount(at[np.repeat(first[x] - ends + n[x], n[x]) + np.arange(ends[-1])], minlength=len(sets))
        near = (label != label[i]) & (both > 0) & (both + 1e-9 >= similarity * (size[i] + size - both))
        if own is not None:
            near &= own != own[i]
        for j in np.flatnonzero(near):
            if label[j] != label[i]:
                out.append((int(nodes[i]), int(nodes[j])))
                label[label == label[j]] = label[i]
    return out


def _named(groups: DataFrame, roots: DataFrame | None, rows: DataFrame, fn, out: T.StructType, name: str) -> tuple[DataFrame, DataFrame]:
    """Each group's members (cell, lo, hi, own, node), dealt in slices, with what ``fn`` makes of their texts. Only texts that a group names are moved."""
    groups = written(groups.select("members").withColumn("cell", F.monotonically_increasing_id()), "jaccard-groups")
    named = groups.select("cell", F.explode("members").alias("node"))
    ends = written(named.select("node").distinct(), "jaccard-ends")
    made = arrow_stage(rows.join(ends, "node"), {"text": "text"}, out, fn, ["node"])
    if roots is None:
        made = made.withColumn("root", F.col("node"))
    else:
        made = made.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    made = written(made, name)
    shingles = named.join(made.select("node", "size"), "node").groupBy("cell").agg(F.sum("size").alias("n"))
    large = written(shingles.where(F.col("n") > CELL_SHINGLES).select("cell", F.ceil(F.col("n") / CELL_SHINGLES).cast("int").alias("m")), "jaccard-large")
    return _dealt(named, ["cell"], large), made


def refined(groups: DataFrame, roots: DataFrame | None, rows: DataFrame, size: int, similarity: float) -> DataFrame:
    """What is left of the groups by a closer bound: counts of the sets' shingles in SKETCH buckets differ by at most as much as the sets."""
    out = T.StructType([T.StructField("sketch", T.BinaryType()), T.StructField("size", T.LongType())])

    def sketch(cols):
        found = [shingle_hashes(fold_words(t), size) for t in texts(cols["text"])]
        counts = [np.minimum(np.bincount((s & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH), 255).astype(np.uint8).tobytes() for s in found]
        return [pa.array(counts, pa.binary()), pa.array([len(s) for s in found], pa.int64())]

    named, made = _named(groups, roots, rows, sketch, out, "jaccard-sketches")

    def gather(t: pa.Table) -> list[tuple[list[int]]]:
        n = t.column(6).to_numpy()
        counts = np.frombuffer(b"".join(t.column(7).to_pylist()), dtype=np.uint8).reshape(len(n), -1)
        cross = t.column(1)[0] != t.column(2)[0]

        def near(at, others):
            apart = np.abs(counts[others].astype(np.int16) - counts[at].astype(np.int16)).sum(axis=1, dtype=np.int64)
            return apart * (1 + similarity) <= (n[others] + n[at]) * (1 - similarity) + 1e-6

        return connected(t.column(4).to_numpy(), t.column(5).to_numpy(), t.column(3).to_numpy() if cross else None, near)

    return _cells(named.join(made, "node").select("cell", "lo", "hi", "own", "node", "root", "size", "sketch"), ["cell"], gather, "members array<long>").distinct()


def links(groups: DataFrame, roots: DataFrame | None, rows: DataFrame, size: int, similarity: float) -> DataFrame:
    """(a, b): links between the similar texts of each group (members), a forest of them."""
    groups = refined(groups, roots, rows, size, similarity)
    out = T.StructType([T.StructField("s", T.ArrayType(T.LongType())), T.StructField("size", T.LongType())])

    def hashes(cols):
        found = [shingle_hashes(fold_words(t), size).view(np.int64) for t in texts(cols["text"])]
        return [pa.array(found, pa.list_(pa.int64())), pa.array([len(x) for x in found], pa.int64())]

    named, sets = _named(groups, roots, rows, hashes, out, "jaccard-sets")

    def work(t: pa.Table) -> list[tuple[int, int]]:
        s = t.column(6).combine_chunks()
        flat, cut = s.flatten().to_numpy().view(np.uint64), np.cumsum(pc.list_value_length(s).to_numpy())[:-1]
        cross = t.column(1)[0] != t.column(2)[0]
        return compare(t.column(4).to_numpy(), t.column(5).to_numpy(), t.column(3).to_numpy() if cross else None, np.split(flat, cut), similarity)

    return _cells(named.join(sets, "node").select("cell", "lo", "hi", "own", "node", "root", "s"), ["cell"], work, "a long, b long")


def shared_prefixes(rows: DataFrame, size: int, similarity: float) -> DataFrame:
    """(token, node, size, pos, bits) of the prefix shingles that several texts share."""
    seen = counts(rows, size)
    found = prefixes(rows, size, similarity, seen)
    if seen.max(initial=0) > HOT:
        # Counted by partial sums, and joined back, where Spark splits what is skewed.
        found = written(found, "jaccard-prefixes")
        many = written(found.groupBy("token").count().where("count > 1").withColumnRenamed("count", "n"), "jaccard-many")
        found = found.join(many, "token", "left").fillna(1, ["n"])
    else:
        found = found.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("token")))
    found = written(found.where("n > 1 OR pos = 0"), "jaccard-shared")
    bits = found.where("pos = 0").select("node", "bits")
    return written(found.where("n > 1").drop("n", "bits").join(bits, "node"), "jaccard-bits")


def similar_groups(rows: DataFrame, size: int = 5, similarity: float = 0.8, candidates: DataFrame | None = None) -> DataFrame:
    """(node, root) for every text (node, text; a written table, nodes unique) that is connected to another; root is the smallest node.

    candidates: pairs of nodes (members, sorted) found by other means; they are compared first, with those of the prefixes' ends.
    """
    found = shared_prefixes(rows, size, similarity)
    row = F.struct("node", "size", "pos", "bits")
    ends = found.groupBy("token").agg(F.min(row).alias("low"), F.max(row).alias("high"))
    ends = ends.select("token", F.explode(F.array("low", "high")).alias("end")).select("token", "end.*")
    # The two bounds again, in the JVM.
    both = (F.col("x.size") + F.col("y.size")).cast("double")
    rest = F.least(F.col("x.size") - F.col("x.pos"), F.col("y.size") - F.col("y.pos"))
    word = lambda t, i: F.conv(F.hex(F.substring(f"{t}.bits", 8 * i + 1, 8)), 16, -10).cast("long")
    apart = sum((F.bit_count(word("x", i).bitwiseXOR(word("y", i))) for i in range(1, 4)), F.bit_count(word("x", 0).bitwiseXOR(word("y", 0))))
    near = found.alias("x").join(ends.alias("y"), "token").where("x.node <> y.node")
    near = near.where((rest * (1 + similarity) >= both * similarity - 1e-6) & (apart * (1 + similarity) <= both * (1 - similarity) + 1e-6))
    pairs = near.select(F.array(F.least("x.node", "y.node"), F.greatest("x.node", "y.node")).alias("members"))
    pairs = (pairs if candidates is None else pairs.unionByName(candidates)).distinct()
    linked = written(links(pairs, None, rows, size, similarity), "jaccard-links")
    roots = written(components(linked), "jaccard-roots")
    # All other texts that may be similar, unless they are connected already.
    found = found.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = found.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
    more = links(clusters(found.join(mixed, "token"), similarity), roots, rows, size, similarity)
    return components(linked.union(more))
