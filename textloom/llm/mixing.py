"""Mixing sources to target weights by iterative proportional fitting.

Token counts per cell (source class, language class, topic) are raked until the
sums over sources, languages and topics meet their target shares; the ratio of
raked to present tokens is a cell's weight. Each document is then kept with a
probability proportional to its cell's weight (1 for the cell with the largest,
or scaled to an expected token ``budget``), decided by a hash of its id.

Targets name classes; '*' takes all other values (and null). The number of
cells is therefore bounded by the targets, however many sources there are, and
raking runs on the driver. A target class without documents passes its share on
to the others in proportion; where the marginals cannot all be met, raking ends
after ``rounds`` rounds at the nearest fit.

``pull`` moves a dimension only part of the way from its present shares (0) to
its targets (1, the default), geometrically.

Topics are hashed vocabulary groups: the one of ``n_topics`` groups that most
words of five or more bytes fall into (ties: the smallest; no such words: 0). A
topic column can be named instead.

Null ids are drawn by the hash of null; rows that repeat an id are kept or go
together. Null and empty texts have no tokens; they have their cell's weight
(1 for cells without tokens). Tables without a source or language column have
one class there, '*'. An empty table gives no rows. Extra columns stay.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import arrow_stage, fold_words, load, small_table, spare, texts, written

TOPICS = 8
#: Columns that mix() adds.
ADDED = ("source", "lang", "topic", "tokens", "weight", "probability", "selected")
#: Target shares of tokens.
TARGETS: dict[str, dict[str, float]] = {
    "source": {"src0": 0.30, **{f"src{i}": 0.68 / 19 for i in range(1, 20)}, "*": 0.02},
    "lang": {"en": 0.57, "de": 0.15, "fr": 0.14, "es": 0.12, "*": 0.02},
    "topic": {str(i): 1 / TOPICS for i in range(TOPICS)},
}


def topic_of(words: list[bytes], n_topics: int) -> int:
    """The vocabulary group of most long words."""
    counts = [0] * n_topics
    for w, n in Counter(words).items():
        if len(w) >= 5:
            counts[zlib.crc32(w) % n_topics] += n
    return counts.index(max(counts))


def rake(cells: np.ndarray, targets: list[np.ndarray], pull: list[float] | None = None, rounds: int = 200, tolerance: float = 1e-9) -> np.ndarray:
    """Raked cells: axis k sums to targets[k] (scaled to the total), or with pull[k] < 1 to shares between the present ones and these. Empty slices pass their share on."""
    total = cells.sum()
    x = cells.astype(float).copy()
    if total <= 0:
        return x
    goals = []
    for k, t in enumerate(targets):
        axes = tuple(i for i in range(cells.ndim) if i != k)
        now = cells.sum(axis=axes) / total
        t = np.where(now > 0, np.asarray(t, dtype=float) / max(np.sum(t), 1e-300), 0.0)
        if pull is not None:
            t = t ** pull[k] * now ** (1 - pull[k])
        goals.append(t / t.sum() * total if t.sum() > 0 else cells.sum(axis=axes).astype(float))
    for _ in range(rounds):
        worst = 0.0
        for k, goal in enumerate(goals):
            axes = tuple(i for i in range(cells.ndim) if i != k)
            now = x.sum(axis=axes)
            ratio = np.divide(goal, now, out=np.ones_like(goal), where=now > 0)
            worst = max(worst, float(np.abs(now - goal).max()) / total)
            shape = [1] * cells.ndim
            shape[k] = -1
            x *= ratio.reshape(shape)
        if worst < tolerance:
            break
    return x


def mix(df: DataFrame, targets: dict[str, dict[str, float]] | None = None, id_col: str = "doc_id", text: str = "text", source_col: str | None = "source", lang_col: str | None = "lang", topic_col: str | None = None, pull: dict[str, float] | None = None, budget: float | None = None, seed: int = 17, keep: list[str] | None = None, prefix: str = "__") -> DataFrame:
    """Adds source, lang, topic, tokens, weight, probability and selected, each name after ``prefix``; they replace columns of the same name.

    Rows are never shuffled. Texts are read twice only where they are kept.
    """
    targets = TARGETS if targets is None else targets
    n_topics = len(targets["topic"])
    keep = df.columns if keep is None else keep
    c_source, c_lang, c_topic, c_tokens, c_weight, c_probability, c_selected = (prefix + x for x in ADDED)
    out = T.StructType([T.StructField(c_tokens, T.LongType()), T.StructField(c_topic, T.StringType())])

    def fn(cols):
        # The words of one text at a time.
        found = [(len(w), str(topic_of(w, n_topics))) for w in map(fold_words, texts(cols["text"]))]
        return [pa.array([n for n, _ in found], pa.int64()), pa.array([t for _, t in found], pa.string())]

    def named(column: str | None, dim: str) -> Column:
        if column is None or column not in df.columns:
            return F.lit("*")
        value = F.col(f"`{column}`").cast("string")
        return F.when(value.isin([k for k in targets[dim] if k != "*"]), value).otherwise(F.lit("*"))

    t_id, t_source, t_lang, t_topic = spare([*df.columns, *(prefix + x for x in ADDED)], "__id", "__s", "__l", "__t")
    rows = df.withColumns({t_id: F.col(f"`{id_col}`"), t_source: named(source_col, "source"), t_lang: named(lang_col, "lang"), t_topic: named(topic_col, "topic")})
    rows = arrow_stage(rows, {"text": text}, out, fn, [*keep, t_id, t_source, t_lang, t_topic])
    rows = rows.withColumns({c_source: F.col(t_source), c_lang: F.col(t_lang)} | ({c_topic: F.col(t_topic)} if topic_col is not None else {})).drop(t_source, t_lang, t_topic)
    if text not in keep:
        rows = written(rows, "mixing-rows")
    dims = [("source", c_source), ("lang", c_lang), ("topic", c_topic)]
    names = [list(targets[d]) + ["*"] * ("*" not in targets[d]) for d, _ in dims]
    found = rows.groupBy(*[c for _, c in dims]).agg(F.sum(c_tokens).alias("n")).collect()  # bounded by the targets
    cells = np.zeros([len(n) for n in names])
    for r in found:
        cells[tuple(n.index(r[k]) for k, n in enumerate(names))] += r["n"] or 0
    raked = rake(cells, [np.array([targets[d].get(k, 0.0) for k in n]) for (d, _), n in zip(dims, names, strict=True)], [(pull or {}).get(d, 1.0) for d, _ in dims])
    weight = np.divide(raked, cells, out=np.ones_like(raked), where=cells > 0)
    scale = 1 / max(weight[cells > 0].max(initial=0.0), 1e-300) if cells.sum() > 0 else 1.0
    if budget is not None:
        lo, hi = 0.0, 1 / max(weight[weight > 0].min(initial=1.0), 1e-300)
        for _ in range(100):
            scale = (lo + hi) / 2
            lo, hi = (scale, hi) if (np.minimum(1, scale * weight) * cells).sum() < budget else (lo, scale)
    spark = df.sparkSession
    table = [(*[n[i] for n, i in zip(names, at, strict=True)], float(weight[at]), float(min(1.0, scale * weight[at]) if cells[at] > 0 else 1.0)) for at in np.ndindex(*cells.shape)]
    schema = T.StructType([T.StructField(c, T.StringType()) for _, c in dims] + [T.StructField(c, T.DoubleType()) for c in (c_weight, c_probability)])
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(t_id)), 11) / F.lit(float(1 << 53))
    rows = rows.drop(c_weight, c_probability, c_selected)
    return rows.join(F.broadcast(small_table(spark, table, schema)), [c for _, c in dims], "left").withColumn(c_selected, draw < F.col(c_probability)).drop(t_id)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cell, tokens, weight, probability and whether it is kept."""
    found = mix(load(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"), keep=["doc_id"])
    return found.select("doc_id", *[F.col(f"__{c}").alias(c) for c in ADDED])


def sample_mix(docs: DataFrame) -> DataFrame:
    """The documents kept, with their own columns, whatever their names."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return mix(docs, prefix=prefix).where(F.col(prefix + "selected")).select(*[F.col(f"`{c}`") for c in docs.columns])
