"""Benchmark decontamination by winnowing.

Both sides keep the smallest k-gram hash of every window of w consecutive
k-grams (rightmost of equals), so any span of w + k - 1 = SPAN words that a
document shares with an item has a kept fingerprint in common. Fingerprints that meet are extended over
equal words to both sides; spans of at least SPAN words are hits, and every
window of SPAN words within them occurs in the document. Items of fewer words
are a single fingerprint of their own length, looked up among all grams of that
length.

A benchmark of at most SLICE_BYTES of text is broadcast with its fingerprints,
and documents are judged where they lie, in one narrow pass. A larger one is
joined as a table of fingerprints; the pairs (document, item) that meet are
then extended text by text. Both ways compare words, so hashes decide no result.

Null texts have no words; items without words are ignored. Repeated items count
once each by id. Rows that repeat a document are judged each. A null item id
counts as an item, written ''. Extra columns stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import arrow_stage, fold_words, load, spare, texts, written

SPAN, GRAM = 10, 6
#: Of benchmark text that is broadcast.
SLICE_BYTES = 32 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive ids, mixed so that minima are spread."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    x = ids.astype(np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        h = h * _MULT + x[i : i + n] + np.uint64(1)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def winnow(h: np.ndarray, w: int) -> np.ndarray:
    """Positions of the minima (rightmost of equals) of all windows of w hashes; of the whole where there are fewer."""
    n = len(h)
    if not n:
        return np.zeros(0, dtype=np.int64)
    w = min(w, n)
    m = n - w + 1
    least, at = h[:m].copy(), np.arange(m)
    for i in range(1, w):
        x = h[i : i + m]
        less = x <= least
        least[less] = x[less]
        at[less] = np.flatnonzero(less) + i
    return np.unique(at)


@dataclass
class Slice:
    """A benchmark, or one item of it: vocabulary, items as ids, and fingerprints sorted by hash with the places (item, position) they stand for."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    names: list[str] = field(default_factory=list)
    items: list[np.ndarray] = field(default_factory=list)
    long_: tuple[np.ndarray, list] | None = None
    short: dict[int, tuple[np.ndarray, list]] = field(default_factory=dict)

    @staticmethod
    def of(rows: list[tuple[str, list[bytes]]]) -> Slice:
        s = Slice()
        found: dict[int, dict[int, list]] = {}
        for name, words in rows:
            if not words:
                continue
            ids = np.array([s.vocabulary.setdefault(w, len(s.vocabulary)) for w in words], dtype=np.int64)
            item = len(s.items)
            s.names.append(name)
            s.items.append(ids)
            n = len(ids)
            if n >= SPAN:
                h = gram_hashes(ids, GRAM)
                for p in winnow(h, SPAN - GRAM + 1):
                    found.setdefault(0, {}).setdefault(int(h[p]), []).append((item, int(p)))
            else:
                found.setdefault(n, {}).setdefault(int(gram_hashes(ids, n)[0]), []).append((item, 0))
        for n, table in found.items():
            keys = sorted(table)
            entry = (np.array(keys, dtype=np.uint64), [table[k] for k in keys])
            if n:
                s.short[n] = entry
            else:
                s.long_ = entry
        return s

    def spans(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit intervals (first word, end) of a document's ids (-1: not in the vocabulary), and the items met."""
        hits: list[tuple[int, int]] = []
        met: set[int] = set()
        if self.long_ is not None and len(ids) >= SPAN:
            h = gram_hashes(ids, GRAM)
            at = winnow(h, SPAN - GRAM + 1)
            done: dict[tuple[int, int], int] = {}  # (item, alignment) -> end of the last span
            for p, places in self._meet(self.long_, h, at):
                for item, q in places:
                    if done.get((item, p - q), -1) > p:
                        continue
                    a, b = self._extend(ids, self.items[item], p, q)
                    done[(item, p - q)] = max(b, p + 1)
                    if b - a >= SPAN:
                        hits.append((a, b))
                        met.add(item)
        for n, table in self.short.items():
            h = gram_hashes(ids, n)
            for p, places in self._meet(table, h, np.arange(len(h))):
                for item, _ in places:
                    if np.array_equal(ids[p : p + n], self.items[item]):
                        hits.append((p, p + n))
                        met.add(item)
        return hits, met

    @staticmethod
    def _meet(table: tuple[np.ndarray, list], h: np.ndarray, at: np.ndarray):
        keys, places = table
        if not len(at):
            return
        x = h[at]
        k = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
        for i in np.flatnonzero(keys[k] == x):
            yield int(at[i]), places[k[i]]

    @staticmethod
    def _extend(a: np.ndarray, b: np.ndarray, p: int, q: int) -> tuple[int, int]:
        """The longest equal span through a[p] and b[q], in places of a; (p, p) if they differ."""
        left = min(p, q)
        back = a[p - left : p + 1][::-1] != b[q - left : q + 1][::-1]
        first = int(back.argmax()) if back.any() else left + 1
        if first == 0:
            return p, p
        right = min(len(a) - p, len(b) - q)
        ahead = a[p : p + right] != b[q : q + right]
        return p - first + 1, p + (int(ahead.argmax()) if ahead.any() else right)


def union_length(spans: list[tuple[int, int]]) -> int:
    total, end = 0, 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


def arrow_hits(found: list[tuple[set, set]]) -> list[pa.Array]:
    """Columns from, to and items of (spans, names)."""
    longs, spans = pa.list_(pa.int64()), [sorted(x) for x, _ in found]
    return [pa.array([[a for a, _ in x] for x in spans], longs), pa.array([[b for _, b in x] for x in spans], longs), pa.array([sorted(x) for _, x in found], pa.list_(pa.string()))]


def print_hashes(words: list[bytes], lengths: list[int] | None) -> np.ndarray:
    """Fingerprints that need no vocabulary: of a document (all grams of the ``lengths`` of short items, winnowed ones else) or an item (None)."""
    ids = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
    found = []
    if len(ids) >= SPAN:
        h = gram_hashes(ids, GRAM)
        found.append(h[winnow(h, SPAN - GRAM + 1)])
    elif lengths is None and len(ids):
        found.append(gram_hashes(ids, len(ids)) + np.uint64(len(ids)))
    for n in lengths or []:
        found.append(gram_hashes(ids, n) + np.uint64(n))
    return np.unique(np.concatenate(found)).view(np.int64) if found else np.zeros(0, dtype=np.int64)


def prints(rows: DataFrame, key: str, lengths: list[int] | None) -> DataFrame:
    """(h, key) of every fingerprint of the rows (key, text)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                found = [print_hashes(fold_words(t), lengths) for t in texts(b.column(1))]
                keys = np.repeat(b.column(0).to_numpy(), [len(x) for x in found])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(keys)], names=["h", key])

    return rows.select(key, "text").mapInArrow(emit, f"h long, {key} long")


def joined(rows: DataFrame, items: DataFrame) -> DataFrame:
    """(row, from, to, items) of the documents (row, text) that share a window with an item (item, name, text); both written tables."""
    short = items.select(F.trim(F.regexp_replace("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ")).alias("t")).where("t <> ''").select(F.size(F.split("t", " ")).alias("n"))
    lengths = sorted(r["n"] for r in short.where(f"n < {SPAN}").distinct().collect())  # fewer than SPAN numbers
    pairs = written(prints(rows, "row", lengths).join(prints(items, "item", None), "h").select("row", "item").distinct(), "decontamination-pairs")
    named = items.select("item", "name", F.col("text").alias("theirs"))
    pairs = rows.join(pairs.join(named, "item"), "row").select("row", "text", "theirs", "name")
    out = T.StructType([T.StructField(c, T.ArrayType(T.LongType())) for c in ("from", "to")] + [T.StructField("items", T.ArrayType(T.StringType()))])

    def fn(cols):
        found = []
        for mine, theirs, name in zip(texts(cols["text"]), texts(cols["theirs"]), cols["name"].to_pylist(), strict=True):
            s = Slice.of([(name, fold_words(theirs))])
            spans, met = s.spans(np.array([s.vocabulary.get(w, -1) for w in fold_words(mine)], dtype=np.int64))
            found.append((set(spans), {name} if met else set()))
        return arrow_hits(found)

    hits = arrow_stage(pairs, {"text": "text", "theirs": "theirs", "name": "name"}, out, fn, ["row"]).where(F.size("items") > 0)
    hits = hits.select("row", F.arrays_zip("from", "to").alias("spans"), F.col("items")[0].alias("name")).groupBy("row")
    hits = hits.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"), F.array_sort(F.collect_set("name")).alias("items"))
    return hits.select("row", F.col("spans.from").alias("from"), F.col("spans.to").alias("to"), "items")


ADDED = ("words", "from", "to", "items")


def find_contamination(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None, prefix: str = "__") -> DataFrame:
    """Adds words (their number), the hit spans (from, to: first words and ends) and items (ids of items met, sorted), each name after ``prefix``.

    They replace columns of the same name. Without a shuffle for a benchmark of at most SLICE_BYTES.
    """
    spark, longs = df.sparkSession, T.ArrayType(T.LongType())
    keep = df.columns if keep is None else keep
    c_words, c_from, c_to, c_items = (prefix + x for x in ADDED)
    words = T.StructField(c_words, T.LongType())
    items = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("name"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size <= SLICE_BYTES:
        rows = items.orderBy("name", "text").where(F.length("text") > 0).collect()  # at most SLICE_BYTES
        shared = spark.sparkContext.broadcast(Slice.of([(r["name"], fold_words(r["text"].encode())) for r in rows]))
        out = T.StructType([words, T.StructField(c_from, longs), T.StructField(c_to, longs), T.StructField(c_items, T.ArrayType(T.StringType()))])

        def fn(cols):
            s = shared.value
            get = s.vocabulary.get
            n, found = [], []
            for t in texts(cols["text"]):
                w = fold_words(t)
                spans, met = s.spans(np.array([get(x, -1) for x in w], dtype=np.int64))
                n.append(len(w))
                found.append((set(spans), {s.names[i] for i in met}))
            return [pa.array(n, pa.int64()), *arrow_hits(found)]

        return arrow_stage(df, {"text": text}, out, fn, keep)
    c_row, c_text = spare([*df.columns, c_words, c_from, c_to, c_items], "__row", "__text")
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(c_text), F.monotonically_increasing_id().alias(c_row))
    rows = written(arrow_stage(rows, {"text": c_text}, T.StructType([words]), lambda cols: [pa.array([len(fold_words(t)) for t in texts(cols["text"])], pa.int64())]), "decontamination-rows")
    items = written(items.where(F.length("text") > 0).withColumn("item", F.monotonically_increasing_id()), "decontamination-items")
    hits = joined(rows.select(F.col(f"`{c_row}`").alias("row"), F.col(f"`{c_text}`").alias("text")), items)
    hits = hits.select(F.col("row").alias(c_row), F.col("from").alias(c_from), F.col("to").alias(c_to), F.col("items").alias(c_items))
    none = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind))
    found = rows.drop(c_from, c_to, c_items, c_text).join(hits, c_row, "left").drop(c_row)
    return found.withColumns({c_from: none(c_from, "array<bigint>"), c_to: none(c_to, "array<bigint>"), c_items: none(c_items, "array<string>")})


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a benchmark window, and the items met."""
    found = find_contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), keep=["doc_id"])
    summary = T.StructType([T.StructField("n_hit", T.LongType()), T.StructField("items_sha256", T.StringType())])

    def fn(cols):
        spans = [union_length(list(zip(a, b, strict=True))) for a, b in zip(cols["a"].to_pylist(), cols["b"].to_pylist(), strict=True)]
        return [pa.array(spans, pa.int64()), pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in cols["i"].to_pylist()])]

    found = arrow_stage(found, {"a": "__from", "b": "__to", "i": "__items"}, summary, fn)
    return found.select("doc_id", F.col("__words").alias("n_words"), "n_hit", F.size("__items").cast("long").alias("n_items"), "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that share no window with the benchmark, with their own columns, whatever their names."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return find_contamination(docs, benchmark, prefix=prefix).where(F.size(prefix + "items") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
  FROM documents
), i AS (
  SELECT item_id, list_filter(string_split_regex(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM iw), dw AS (
  SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)
), hits AS (
  SELECT dw.doc_id, dw.p, dw.n, iw.item_id FROM dw JOIN iw USING (n, g)
), places AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id
), met AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN met USING (doc_id)
"""
