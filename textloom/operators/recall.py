"""Vector memory: exact and indexed retrieval, its evaluation, trust of proposals, dreams, histories, draws and coverage.

Vectors are compared as matrices, a batch of rows at a time: each task keeps the
best rows of each query, so what moves is k rows a query and task. The SQL of
each query is written from the definitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions.embedding import Embedder, embed_column
from textloom.operators import labels
from textloom.operators.labels import _DOCS, stored
from textloom.plans.ranking import global_rank, running_sum
from textloom.sources import stores

#: Queries that are compared at once.
BLOCK = 4096
#: Rows of vectors that are held at once.
ROWS = 8192


def _read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _vectors(spark, sf_dir) -> DataFrame:
    return _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(-1, dim)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each row of scores the ids of the k largest, the smaller id of equals first, and their scores."""
    out = []
    for s in scores:
        if len(s) > 4 * k:
            least = np.partition(s, -k)[-k]
            at = np.flatnonzero(s >= least)
        else:
            at = np.arange(len(s))
        at = at[np.lexsort((ids[at], -s[at]))][:k]
        at = at[s[at] > -np.inf]
        out.append((ids[at], s[at]))
    return out


def similarity(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Cosines, or negative distances, rounded to nine places."""
    if metric == "cosine":
        return np.round((a @ b.T) / (np.sqrt((a * a).sum(axis=1))[:, None] * np.sqrt((b * b).sum(axis=1))), 9)
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
    return -np.round(np.sqrt(np.maximum(square, 0)), 6)


def usable(dim: int) -> Column:
    return F.col("embedding").isNotNull() & (F.size("embedding") == dim) & F.exists("embedding", lambda x: x != 0)


def exact_nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, metric: str = "cosine", dim: int = 64, own: bool = False) -> DataFrame:
    """(query, id, rank, score): the k best of all rows (id, embedding) for each query, equal scores in order of id.

    Queries go through the table in blocks of BLOCK, each a matrix on every
    executor. Null, zero and other-sized vectors neither ask nor answer; a query
    does not find the row of its own id unless ``own`` is set.
    """
    spark = vectors.sparkSession
    ask = stored(queries.where(usable(dim)).select("id", "embedding").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(1 << 20))), "queries")
    blocks = max(1, -(-ask.count() // BLOCK))
    rows = vectors.where(usable(dim)).select("id", "embedding")
    found = None
    for b in range(blocks):
        held = ask.where(F.pmod("block", F.lit(blocks)) == b).orderBy("id").collect()  # about BLOCK rows
        if not held:
            continue
        shared = spark.sparkContext.broadcast((np.array([r["id"] for r in held]), np.array([r["embedding"] for r in held], dtype=float)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, asked = shared.value
            best = [(np.zeros(0, dtype=np.int64), np.zeros(0)) for _ in names]
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    ids, scores = part.column(0).to_numpy(), similarity(asked, _matrix(part.column(1), dim), metric)
                    if not own:
                        scores[names[:, None] == ids] = -np.inf
                    for i, (x, s) in enumerate(_best(scores, ids, k)):
                        both, more = np.concatenate([best[i][1], s]), np.concatenate([best[i][0], x])
                        keep = np.lexsort((more, -both))[:k]
                        best[i] = (more[keep], both[keep])
            n = [len(x) for x, _ in best]
            if sum(n):
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, n)), pa.array(np.concatenate([x for x, _ in best])), pa.array(np.concatenate([s for _, s in best]))], names=["query", "id", "score"])

        part = rows.mapInArrow(run, "query long, id long, score double")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "query long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id")).cast("long")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "id", "rank", (F.col("score") if metric == "cosine" else -F.col("score")).alias("score"))


# An inverted file.


def bounded_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` rows by hash of the key: rows beyond a bound on the hash do not leave their tasks."""
    count = rows.count()
    if count > n:
        rows = rows.where(F.shiftrightunsigned(F.xxhash64(key), 1) < int((1 << 63) * min(1.0, 1.3 * n / count)))
    return rows.orderBy(F.xxhash64(key), key).limit(n)


def cells_for(n: int) -> int:
    """Cells of an index of n rows: about the square root, 16 to 4096."""
    return int(min(4096, max(16, round(n**0.5))))


def fit_cells(vectors: DataFrame, cells: int | None = None, sample: int | None = None, rounds: int = 12) -> np.ndarray:
    """Unit centres by k-means on at most ``sample`` vectors (by default 32 a cell, at least 8,192)."""
    cells = cells_for(vectors.count()) if cells is None else cells
    held = bounded_sample(vectors, "id", sample or max(8192, 32 * cells)).select("embedding").collect()
    if not held:
        return np.zeros((0, 0))
    m = np.array([r[0] for r in held], dtype=float)
    m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
    centres = m[:cells].copy()
    for _ in range(rounds):
        near = (m @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, m)
        filled = np.bincount(near, minlength=len(centres)) > 0
        centres[filled] = sums[filled]
        centres /= np.maximum(np.sqrt((centres * centres).sum(axis=1, keepdims=True)), 1e-12)
    return centres


def in_cells(rows: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """(id, embedding, cell) for the ``probes`` cells nearest to each row."""
    shared, dim = rows.sparkSession.sparkContext.broadcast(centres), centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                near = _matrix(part.column(1), dim) @ shared.value.T
                cells = near.argmax(axis=1)[:, None] if probes == 1 else np.argsort(-near, axis=1)[:, :probes]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(list(cells.astype(np.int64)), pa.list_(pa.int64()))], names=["id", "embedding", "cells"])

    return rows.select("id", "embedding").mapInArrow(run, "id long, embedding array<float>, cells array<long>").select("id", "embedding", F.explode("cells").alias("cell"))


def probes_for(vectors: DataFrame, centres: np.ndarray, k: int, recall: float, sample: int = 128) -> int:
    """How many cells a query must probe so that the share ``recall`` of its k nearest is met, measured on a sample of rows against all rows."""
    asked = bounded_sample(vectors, "id", sample)
    true = exact_nearest(vectors, asked, k, dim=centres.shape[1])
    hits = true.select("query", "id").join(vectors.select("id", F.col("embedding").alias("theirs")), "id").join(vectors.select(F.col("id").alias("query"), F.col("embedding").alias("mine")), "query").select("mine", "theirs").collect()  # sample x k rows
    if not hits:
        return 1
    mine, theirs = (np.array([r[i] for r in hits], dtype=float) for i in (0, 1))
    order = np.argsort(-(mine @ centres.T), axis=1)
    place = (order == (theirs @ centres.T).argmax(axis=1)[:, None]).argmax(axis=1)
    return int(np.sort(place)[min(len(place) - 1, int(np.ceil(recall * len(place))))]) + 1


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, recall: float = 0.95, cells: int | None = None, probes: int | None = None, dim: int = 64) -> DataFrame:
    """(query, id, rank, score): the k nearest of all rows for each query, over the probed cells of an inverted file.

    Every row is indexed. Cells follow the number of rows, probes the recall
    measured on a sample. A cell's queries meet its rows as a stream: only the
    queries and their best rows are held, however many rows a cell has; large
    cells are dealt out in slices of rows. Zero vectors find and are found by none.
    """
    rows = vectors.where(usable(dim)).select("id", "embedding")
    centres = fit_cells(rows, cells)
    if not len(centres):
        return vectors.sparkSession.createDataFrame([], "query long, id long, rank long, score double")
    probes = probes_for(rows, centres, k, recall) if probes is None else probes
    placed = stored(in_cells(rows, centres, 1), "cells")
    sizes = placed.groupBy("cell").count().select("cell", F.ceil(F.col("count") / 65536).cast("int").alias("m"))  # a row a cell
    placed = placed.join(F.broadcast(sizes), "cell").select("cell", F.pmod(F.xxhash64("id"), F.col("m")).cast("int").alias("part"), F.lit(1).alias("kind"), "id", "embedding")
    asked = in_cells(queries.where(usable(dim)), centres, min(probes, len(centres))).join(F.broadcast(sizes), "cell")
    asked = asked.select("cell", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("part"), F.lit(0).alias("kind"), "id", "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, names, held, best = None, [], [], []

        def out():
            n = [len(x) for x, _ in best]
            if sum(n):
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(names), n)), pa.array(np.concatenate([x for x, _ in best])), pa.array(np.concatenate([s for _, s in best]))], names=["query", "id", "score"])

        for batch in batches:
            cell, part, kind, ids = (batch.column(i).to_numpy() for i in range(4))
            m = _matrix(batch.column(4), dim)
            new = np.flatnonzero((np.diff(cell) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *new], [*new, len(ids)], strict=True):
                if a == b:
                    continue
                if (cell[a], part[a]) != now:
                    yield from out()
                    now, names, held, best = (cell[a], part[a]), [], [], []
                if kind[a] == 0:
                    names += ids[a:b].tolist()
                    held.append(m[a:b])
                    best += [(np.zeros(0, dtype=np.int64), np.zeros(0)) for _ in range(a, b)]
                elif names:
                    q = np.concatenate(held)
                    held = [q]
                    for at in range(0, len(q), BLOCK):
                        scores = similarity(q[at : at + BLOCK], m[a:b], "cosine")
                        scores[np.array(names[at : at + BLOCK])[:, None] == ids[a:b]] = -np.inf
                        for i, (x, s) in enumerate(_best(scores, ids[a:b], k), at):
                            both, more = np.concatenate([best[i][1], s]), np.concatenate([best[i][0], x])
                            keep = np.lexsort((more, -both))[:k]
                            best[i] = (more[keep], both[keep])
        yield from out()

    n = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    met = asked.unionByName(placed).repartition(n, "cell", "part").sortWithinPartitions("cell", "part", "kind", "id").mapInArrow(run, "query long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id")).cast("long")
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "id", "rank", "score")


def evaluate(found: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: mean recall, precision and reciprocal rank of results (query, id, rank) against (query, id), and the number of queries of the truth."""
    n = truth.groupBy("query").agg(F.count(F.lit(1)).alias("relevant"))
    hits = found.join(truth.select("query", "id", F.lit(1).alias("hit")), ["query", "id"], "left")
    per = hits.groupBy("query").agg(F.count(F.lit(1)).alias("shown"), F.count("hit").alias("hits"), F.min(F.when(F.col("hit") == 1, F.col("rank"))).alias("first"))
    rows = n.join(per, "query", "left")
    none = lambda c: F.coalesce(c, F.lit(0.0))
    return rows.agg(F.round(F.avg(none(F.col("hits") / F.col("relevant"))), 6).alias("recall"), F.round(F.avg(none(F.col("hits") / F.col("shown"))), 6).alias("precision"), F.round(F.avg(none(1 / F.col("first"))), 6).alias("mrr"), F.count(F.lit(1)).alias("num_queries"))


def dispersion(found: DataFrame) -> DataFrame:
    """(query, dispersion): the spread of a query's scores, 0 below two."""
    return found.groupBy("query").agg(F.when(F.count("score") < 2, 0.0).otherwise(F.stddev_pop("score")).alias("dispersion"))


def random_queries(spark: SparkSession, n: int, dim: int = 64, seed: int = 42) -> DataFrame:
    """(id, embedding): ``n`` vectors of hashed numbers between -1 and 1, a few by the caller's choice."""
    number = lambda j, i: int(hashlib.md5(f"{seed}:{j}:{i}".encode()).hexdigest()[:8], 16) / 2147483648 - 1
    return spark.createDataFrame([(-1 - j, [number(j, i) for i in range(dim)]) for j in range(n)], "id long, embedding array<float>")


def dream(memory: DataFrame, contents: DataFrame, n: int = 10, dim: int = 64, mutations: int = 2, embedder: Embedder | None = None) -> DataFrame:
    """New memories (mid, content, embedding, tag, r): for each of ``n`` random queries the two nearest of five, their content with a variant's mark, shortened."""
    found = exact_nearest(memory, random_queries(memory.sparkSession, n, dim), 5, dim=dim).where(F.col("rank") <= mutations).join(contents, "id", "left")
    content = F.concat(F.substring(F.concat(F.coalesce("content", F.lit("")), F.lit(" hypothetical variant")), 1, 100), F.lit("..."))
    mid = F.concat(F.lit("dream_"), F.col("id").cast("string"), F.lit("_"), (-F.col("query") - 1).cast("string"))
    return found.select(mid.alias("mid"), content.alias("content")).withColumn("embedding", embed_column(F.col("content"), embedder)).withColumns({"tag": F.lit("dream"), "r": F.lit(0.3)})


# Proposals.


def pre_trust(proposals: DataFrame) -> Column:
    """0.4 reputation + 0.3 evidence + 0.2 score + 0.05 if seen within a day - up to 0.2 for time, over columns reputation, tag_match, supporting, benefit, score, recent, seconds."""
    evidence = 0.2 * F.col("tag_match") + 0.5 * F.least(F.lit(1.0), F.col("supporting") / 10) + 0.3 * F.when(F.col("supporting") > 0, F.col("benefit") / F.col("supporting")).otherwise(0.0)
    return 0.4 * F.col("reputation") + 0.3 * evidence + 0.2 * F.col("score") + F.when(F.col("recent"), 0.05).otherwise(0.0) - F.least(F.lit(0.2), F.col("seconds") / 10)


def calibrated(raw: Column, levels: list[float]) -> Column:
    """Straight lines between rising levels at equal steps."""
    x = F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0)) * (len(levels) - 1)
    at = F.least(F.floor(x), F.lit(len(levels) - 2)).cast("int")
    held = F.array(*[F.lit(float(v)) for v in levels])
    return F.get(held, at) + (x - at) * (F.get(held, at + 1) - F.get(held, at))


def fit_levels(rows: DataFrame, raw: str, reward: str, knots: int = 6) -> list[float]:
    """Mean reward of each of ``knots`` buckets, made to rise; a bucket without rewards keeps its own place."""
    clipped = F.least(F.greatest(F.col(raw), F.lit(0.0)), F.lit(1.0))
    found = rows.groupBy(F.least(F.lit(knots - 1), F.floor(clipped * knots)).alias("b")).agg(F.avg(reward).alias("m")).collect()  # a row a bucket
    means = {int(r["b"]): r["m"] for r in found}
    return np.maximum.accumulate([means.get(i, i / (knots - 1)) for i in range(knots)]).tolist()


def score_proposals(proposals: DataFrame, policy: Callable[[], Column] | Column, rewards: str = "reward") -> DataFrame:
    """Adds pre (raw trust) and trust: calibrated against the rewards, -1 where the policy fails."""
    ok = policy() if callable(policy) and not isinstance(policy, Column) else policy
    rows = stored(proposals.withColumn("pre", pre_trust(proposals)).withColumn("ok", F.coalesce(ok, F.lit(True))), "proposals")
    levels = fit_levels(rows.where("ok"), "pre", rewards)
    return rows.withColumn("trust", F.when(F.col("ok"), calibrated(F.col("pre"), levels)).otherwise(-1.0)).withColumn("pre", F.when(F.col("ok"), F.col("pre")).otherwise(-1.0)).drop("ok")


def event_proposals(spark, sf_dir) -> DataFrame:
    """Events as proposals: the user's reputation, a tag match for clicks, earlier like events as support, the value as score, the gap as time."""
    events = _read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    standing = stores.reputations(events.select(F.col("user_id").alias("name"), F.col("event_id").alias("id"), ((F.col("value") - 50) / 100).alias("reward"), F.col("us").alias("seen")))
    score = stores.reputation_score(F.col("n"), F.col("reward_sum"), F.col("reward_sq"))
    like = Window.partitionBy("user_id", "event_type").orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    gap = F.col("us") - F.lag("us").over(Window.partitionBy("user_id").orderBy("event_id"))
    rows = events.withColumns({"supporting": F.count(F.lit(1)).over(like), "benefit": F.coalesce(F.sum(F.when(F.col("value") > 50, 1).otherwise(0)).over(like), F.lit(0)), "gap": gap})
    rows = rows.join(standing.select(F.col("name").alias("user_id"), score.alias("reputation")), "user_id")
    return rows.withColumns({
        "tag_match": F.when(F.col("event_type") == "click", 1.0).otherwise(0.0), "score": F.least(F.lit(1.0), F.col("value") / 1000), "recent": F.coalesce(F.col("gap") < 86400000000, F.lit(False)),
        "seconds": F.coalesce(F.col("gap"), F.lit(0)) / 36000000000, "reward": F.when(F.col("value") > 50, 1.0).otherwise(0.0),
    })


# Queries.


def v1_embed(spark, sf_dir):
    rows = _read(spark, sf_dir, "documents").select("doc_id", F.posexplode(embed_column(F.col("text"))).alias("pos", "x"))
    return rows.where("x <> 0").select("doc_id", F.col("pos").cast("long").alias("pos"), F.round("x", 6).alias("x"))


def unit(v: Column) -> Column:
    """The vector at length 1; a zero vector stays."""
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(0.0))


def v2_unit(spark, sf_dir):
    """Vectors at length 1, those of every seventh id set to zero before."""
    v = F.when(F.col("vec_id") % 7 == 0, F.transform("embedding", lambda x: x * 0)).otherwise(F.transform("embedding", lambda x: x * 3))
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(unit(v)).alias("pos", "x"))
    return rows.select("vec_id", F.col("pos").cast("long").alias("pos"), F.round("x", 5).alias("x"))


def _asked(spark, sf_dir, k: int = 5, metric: str = "cosine") -> DataFrame:
    """All rows for every 50th."""
    vectors = _vectors(spark, sf_dir)
    return exact_nearest(vectors, vectors.where("id % 50 = 0"), k, metric)


def v4_retrieve(spark, sf_dir):
    return _asked(spark, sf_dir).select("query", F.col("id").alias("vec_id"), "rank")


def l2_distance(spark, sf_dir):
    return _asked(spark, sf_dir, metric="distance").select("query", F.col("id").alias("vec_id"), "rank", F.col("score").alias("distance"))


def v5_nearest(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    return nearest(vectors, vectors.where("id % 50 = 0")).select("query", F.col("id").alias("vec_id"), "rank")


def g16_evaluation(spark, sf_dir):
    """Ten results a query; those of the query's label are relevant."""
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", "label")
    asked = rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), "label")
    truth = asked.join(rows.withColumnRenamed("vec_id", "id"), "label").where("query <> id").select("query", "id")
    return evaluate(_asked(spark, sf_dir, 10), truth)


def g20_dispersion(spark, sf_dir):
    return dispersion(_asked(spark, sf_dir)).withColumn("dispersion", F.round("dispersion", 6))


def previews(found: DataFrame, contents: DataFrame, least: float = 0.4) -> DataFrame:
    """(query, preview): results of ``least`` or more as lines of score and the first 200 characters, in order of rank."""
    rows = found.where(F.col("score") >= least).join(contents, "id")
    line = F.concat(F.lit("["), F.format_string("%.2f", "score"), F.lit("] "), F.substring("content", 1, 200), F.lit("..."))
    return rows.groupBy("query").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))), lambda x: x["line"]), "\n").alias("preview"))


def f9_preview(spark, sf_dir):
    """Among the tables' vectors few are nearer than 0.25, which stands in for 0.4 here."""
    contents = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    return previews(_asked(spark, sf_dir), contents, 0.25).select("query", F.md5("preview").alias("preview_md5"))


def v12_dream(spark, sf_dir):
    contents = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    return dream(_vectors(spark, sf_dir), contents).select("mid", F.md5("content").alias("content_md5"), "tag", "r")


def v14_tags(spark, sf_dir):
    tags = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("tag"))
    found = _asked(spark, sf_dir).join(tags, "id").groupBy("query").agg(F.array_join(F.array_sort(F.collect_set("tag")), ",").alias("tags"))
    return found


def q_trust(spark, sf_dir):
    """Proposals of errors fail the policy."""
    found = score_proposals(event_proposals(spark, sf_dir), F.col("event_type") != "error")
    return found.select("event_id", "user_id", F.round(F.col("pre") + 1e-9, 5).alias("pre"), F.round(F.col("trust") + 1e-9, 5).alias("trust"))


def l3_winner(spark, sf_dir):
    """A user's five best proposals, and the winner among them if its trust exceeds 0.01."""
    w = Window.partitionBy("user_id").orderBy(F.desc("trust"), "event_id")
    ranked = q_trust(spark, sf_dir).withColumn("rank", F.row_number().over(w).cast("long")).where("rank <= 5")
    return ranked.select("user_id", "event_id", "rank", ((F.col("rank") == 1) & (F.col("trust") > 0.01)).alias("wins"))


def g18_calibration(spark, sf_dir):
    return q_trust(spark, sf_dir).where("trust >= 0").select("event_id", F.col("trust").alias("calibrated"))


def l5_partners(spark, sf_dir):
    """The five best partners of each theme."""
    pairs = labels.count_pairs(labels.records(spark, sf_dir))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("n"), "b")).cast("long")
    return pairs.withColumn("rank", rank).where("rank <= 5").select(F.col("a").alias("theme"), F.col("b").alias("partner"), "rank")


def held_after(n: Column, cap: int) -> Column:
    """How many of n entries a log holds that drops its oldest quarter whenever it exceeds ``cap``."""
    drop = (cap + 1) // 4
    return F.when(n <= cap, n).otherwise(cap + 1 - drop + F.pmod(n - (cap + 1), F.lit(drop)))


def l9_history(spark, sf_dir):
    """Which of three bounded histories still hold an event: the last 1,000 of all, the last 100 of a user, and a user's log that drops a quarter beyond 40."""
    events = _read(spark, sf_dir, "events").select("event_id", "user_id")
    w = Window.partitionBy("user_id")
    rows = events.withColumn("r", F.row_number().over(w.orderBy(F.desc("event_id")))).withColumn("n", F.count(F.lit(1)).over(w))
    last = events.orderBy(F.desc("event_id")).limit(1000).select("event_id", F.lit(True).alias("errors"))
    rows = rows.join(F.broadcast(last), "event_id", "left")  # 1,000 rows
    return rows.select("event_id", F.coalesce("errors", F.lit(False)).alias("in_errors"), (F.col("r") <= 100).alias("in_times"), (F.col("r") <= held_after(F.col("n"), 40)).alias("in_proposals"))


def weighted_draws(rows: DataFrame, key: str, weight: str, n: int, seed: int = 42) -> DataFrame:
    """(key, times): ``n`` draws with replacement by whole-numbered weights; draws are numbers of a seeded hash over the sum of weights.

    Each row stands for a range of the running sum; each task counts the draws
    that fall in its rows' ranges, and nothing else moves.
    """
    placed = running_sum(rows.where(F.col(weight) > 0).select(key, F.col(weight).cast("long").alias("w")), [F.asc(key)], "w", "to")
    total = rows.where(F.col(weight) > 0).agg(F.coalesce(F.sum(F.col(weight).cast("long")), F.lit(0))).first()[0]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        draws = np.sort(np.array([int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13], 16) % max(total, 1) for i in range(n)], dtype=np.int64))
        for f in frames:
            f["times"] = np.searchsorted(draws, f["to"].to_numpy()) - np.searchsorted(draws, (f["to"] - f["w"]).to_numpy())
            yield f[[key, "times"]]

    return placed.select(key, "w", "to").mapInPandas(run, f"{key} long, times long").where("times > 0")


def l8_draws(spark, sf_dir):
    return weighted_draws(_read(spark, sf_dir, "documents"), "doc_id", "n_chars", 1000)


def coverage_steps(rows: DataFrame, key: str, known: int) -> DataFrame:
    """(key, step, seen, coverage, checked, stops) of rows (key, fresh: themes not seen before): checked each step from 0.95 on, each tenth from 0.9, else each hundredth; stops at full coverage."""
    found = global_rank(running_sum(rows, [F.asc(key)], "fresh", "seen"), [F.asc(key)], "step")
    share = F.col("seen") / F.lit(max(known, 1))
    checked = F.when(share >= 0.95, F.lit(True)).when(share >= 0.9, F.col("step") % 10 == 0).otherwise(F.col("step") % 100 == 0)
    return found.select(key, F.col("step").cast("long").alias("step"), F.col("seen").cast("long").alias("seen"), F.round(share, 6).alias("coverage"), checked.alias("checked"), (checked & (share >= 1.0)).alias("stops"))


def w12_coverage(spark, sf_dir):
    found = stored(labels.labelled(labels.candidates(labels.documents(spark, sf_dir))).select(F.col("id").alias("doc_id"), F.explode("themes").alias("theme")), "w12")
    firsts = found.groupBy("theme").agg(F.min("doc_id").alias("doc_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("fresh"))
    rows = _read(spark, sf_dir, "documents").select("doc_id").join(firsts, "doc_id", "left").fillna(0, ["fresh"])
    return coverage_steps(rows, "doc_id", found.select("theme").distinct().count())


def g22_rates(spark, sf_dir, batch: int = 8):
    """Steps and samples a second between a user's events."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = _read(spark, sf_dir, "events").withColumn("us", us).withColumn("gap", F.col("us") - F.lag("us").over(w))
    rate = F.when(F.col("gap") > 0, 1e6 / F.col("gap"))
    return rows.select("event_id", F.col("gap").alias("gap_us"), F.round(rate, 9).alias("steps_per_second"), F.round(rate * batch, 9).alias("samples_per_second"))


def e7_retired(spark, sf_dir):
    """Users as experts: retired by three failures in a row, counted from the last success."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    rows = _read(spark, sf_dir, "events").select("user_id", "event_id", (F.col("value") < 10).alias("bad"))
    rows = rows.withColumn("run", F.sum(F.when(F.col("bad"), 0).otherwise(1)).over(w))
    runs = rows.groupBy("user_id", "run").agg(F.sum(F.when(F.col("bad"), 1).otherwise(0)).alias("failures"))
    return runs.groupBy("user_id").agg(F.max("failures").alias("longest"), (F.max("failures") >= 3).alias("retired"))


QUERIES = {
    "V1_embed": v1_embed, "V2_unit_vectors": v2_unit, "V4_retrieve": v4_retrieve, "L2_distance": l2_distance, "V5_nearest": v5_nearest, "G16_evaluation": g16_evaluation, "G20_dispersion": g20_dispersion, "F9_preview": f9_preview, "V12_dream": v12_dream, "V14_context_tags": v14_tags,
    "Q_trust": q_trust, "L3_winner": l3_winner, "G18_calibration": g18_calibration, "L5_partners": l5_partners, "L9_history": l9_history, "L8_weighted_draws": l8_draws, "W12_coverage": w12_coverage, "G22_step_rates": g22_rates, "E7_retired": e7_retired,
}


def _scored(metric: str, k: int) -> str:
    dot = lambda a, b: f"list_inner_product(CAST({a}.embedding AS DOUBLE[]), CAST({b}.embedding AS DOUBLE[]))"
    score = f"round({dot('x', 'y')} / (sqrt({dot('x', 'x')}) * sqrt({dot('y', 'y')})), 9)" if metric == "cosine" else f"-round(sqrt(greatest({dot('x', 'x')} + {dot('y', 'y')} - 2 * {dot('x', 'y')}, 0)), 6)"
    return f"SELECT * FROM (SELECT query, vec_id, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank FROM (SELECT x.vec_id AS query, y.vec_id, {score} AS score FROM embeddings x JOIN embeddings y ON x.vec_id <> y.vec_id AND x.vec_id % 50 = 0) s) r WHERE rank <= {k}"


_R = "WITH r AS (" + _scored("cosine", 5) + ")"
_DREAM = f"""WITH q AS (SELECT j, list(CAST(CAST('0x' || substr(md5('42:' || j || ':' || i), 1, 8) AS BIGINT) / 2147483648e0 - 1 AS FLOAT) ORDER BY i) AS embedding FROM range(10) a(j), range(64) b(i) GROUP BY j),
s AS (SELECT q.j, e.vec_id, round(list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) / (sqrt(list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))) * sqrt(list_inner_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])))), 9) AS score FROM q, embeddings e),
r AS (SELECT *, row_number() OVER (PARTITION BY j ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT 'dream_' || r.vec_id || '_' || r.j AS mid, md5(substr(coalesce(d.text, '') || ' hypothetical variant', 1, 100) || '...') AS content_md5, 'dream' AS tag, 0.3e0 AS r FROM r LEFT JOIN documents d ON d.doc_id = r.vec_id WHERE rank <= 2"""
_TRUST = """WITH u AS (SELECT user_id, count(*) AS n, sum((value - 50) / 100) AS s, sum((value - 50) / 100 * ((value - 50) / 100)) AS q FROM events GROUP BY user_id),
rep AS (SELECT user_id, least(1e0, greatest(0e0, s / n + sqrt(2 * ln(n + 1) / n) * sqrt(greatest(q / n - (s / n) * (s / n), 0)))) AS reputation FROM u),
e AS (SELECT *, count(*) OVER w AS k, coalesce(sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) OVER w, 0) AS b, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY event_id) AS gap FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
p AS (SELECT e.event_id, e.user_id, e.event_type <> 'error' AS ok, CASE WHEN value > 50 THEN 1e0 ELSE 0e0 END AS reward, 0.4e0 * reputation + 0.3e0 * (0.2e0 * CASE WHEN event_type = 'click' THEN 1 ELSE 0 END + 0.5e0 * least(1e0, k / 10e0) + 0.3e0 * CASE WHEN k > 0 THEN b / k ELSE 0 END) + 0.2e0 * least(1e0, value / 1000)
 + CASE WHEN gap < 86400000000 THEN 0.05e0 ELSE 0 END - least(0.2e0, coalesce(gap, 0) / 36000000000e0 / 10) AS pre FROM e JOIN rep ON rep.user_id = e.user_id),
c AS (SELECT *, least(greatest(pre, 0), 1) AS z FROM p), m AS (SELECT least(5, floor(z * 6)) AS i, avg(reward) AS m FROM c WHERE ok GROUP BY 1),
lv AS (SELECT i, max(coalesce(m.m, i / 5e0)) OVER (ORDER BY i) AS level FROM range(6) g(i) LEFT JOIN m USING (i)),
t AS (SELECT c.event_id, c.user_id, CASE WHEN ok THEN pre ELSE -1 END AS pre, CASE WHEN ok THEN a.level + (z * 5 - a.i) * (b.level - a.level) ELSE -1 END AS trust FROM c JOIN lv a ON a.i = least(floor(z * 5), 4) JOIN lv b ON b.i = a.i + 1),
f AS (SELECT event_id, user_id, round(pre + 1e-9, 5) AS pre, round(trust + 1e-9, 5) AS trust FROM t)"""

ORACLE_SQL = {
    "V1_embed": r"""WITH s AS (SELECT doc_id, h % 64 AS pos, sum(CASE WHEN h >= 2147483648 THEN 1 ELSE -1 END) AS v FROM (SELECT doc_id, CAST('0x' || substr(md5(unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'))), 1, 8) AS BIGINT) AS h FROM documents) w GROUP BY doc_id, pos)
SELECT doc_id, pos, round(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)), 6) AS x FROM s WHERE v <> 0""",
    "V2_unit_vectors": """WITH s AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, CASE WHEN vec_id % 7 = 0 THEN 0 ELSE CAST(unnest(embedding) AS DOUBLE) END AS x FROM embeddings)
SELECT vec_id, pos, round(CASE WHEN vec_id % 7 = 0 THEN 0e0 ELSE x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)) END, 5) AS x FROM s""",
    "V4_retrieve": f"{_R} SELECT query, vec_id, rank FROM r",
    "L2_distance": f"SELECT query, vec_id, rank, -score AS distance FROM ({_scored('distance', 5)}) z",
    "G16_evaluation": f"""WITH r AS ({_scored('cosine', 10)}), t AS (SELECT a.vec_id AS query, b.vec_id FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id AND a.vec_id % 50 = 0),
n AS (SELECT query, count(*) AS relevant FROM t GROUP BY query), h AS (SELECT r.query, count(t.vec_id) AS hits, count(*) AS shown, min(CASE WHEN t.vec_id IS NOT NULL THEN rank END) AS first FROM r LEFT JOIN t ON t.query = r.query AND t.vec_id = r.vec_id GROUP BY r.query)
SELECT round(avg(coalesce(hits / relevant, 0)), 6) AS recall, round(avg(coalesce(hits / shown, 0)), 6) AS precision, round(avg(coalesce(1e0 / first, 0)), 6) AS mrr, count(*) AS num_queries FROM n LEFT JOIN h USING (query)""",
    "G20_dispersion": f"{_R} SELECT query, round(CASE WHEN count(*) < 2 THEN 0 ELSE stddev_pop(score) END, 6) AS dispersion FROM r GROUP BY query",
    "F9_preview": f"{_R} SELECT query, md5(string_agg('[' || printf('%.2f', score) || '] ' || substr(d.text, 1, 200) || '...', chr(10) ORDER BY rank)) AS preview_md5 FROM r JOIN documents d ON d.doc_id = r.vec_id WHERE score >= 0.25 GROUP BY query",
    "V12_dream": _DREAM,
    "V14_context_tags": f"{_R} SELECT query, string_agg(tag, ',' ORDER BY tag) AS tags FROM (SELECT DISTINCT query, CAST(label AS VARCHAR) AS tag FROM r JOIN embeddings e ON e.vec_id = r.vec_id) z GROUP BY query",
    "Q_trust": f"{_TRUST} SELECT * FROM f",
    "L3_winner": f"{_TRUST} SELECT user_id, event_id, rank, rank = 1 AND trust > 0.01 AS wins FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY trust DESC, event_id) AS rank FROM f) z WHERE rank <= 5",
    "G18_calibration": f"{_TRUST} SELECT event_id, trust AS calibrated FROM f WHERE trust >= 0",
    "L5_partners": f"{labels._BOTH} SELECT a AS theme, b AS partner, rank FROM (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS rank FROM pairs) z WHERE rank <= 5",
    "L9_history": """SELECT event_id, row_number() OVER (ORDER BY event_id DESC) <= 1000 AS in_errors, r <= 100 AS in_times, r <= CASE WHEN n <= 40 THEN n ELSE 31 + (n - 41) % 10 END AS in_proposals
FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events) z""",
    "L8_weighted_draws": """WITH c AS (SELECT doc_id, n_chars AS w, sum(n_chars) OVER (ORDER BY doc_id) AS hi FROM documents WHERE n_chars > 0), d AS (SELECT CAST('0x' || substr(md5('42:' || i), 1, 13) AS BIGINT) % (SELECT sum(n_chars) FROM documents WHERE n_chars > 0) AS u FROM range(1000) g(i))
SELECT doc_id, count(*) AS times FROM d JOIN c ON d.u >= c.hi - c.w AND d.u < c.hi GROUP BY doc_id""",
    "W12_coverage": f"""WITH {_DOCS}, f AS (SELECT theme, min(id) AS id FROM (SELECT id, unnest(themes) AS theme FROM d_lab) x GROUP BY theme), n AS (SELECT id, count(*) AS fresh FROM f GROUP BY id),
s AS (SELECT d.id, row_number() OVER (ORDER BY d.id) AS step, CAST(sum(coalesce(n.fresh, 0)) OVER (ORDER BY d.id) AS BIGINT) AS seen FROM d_src d LEFT JOIN n ON n.id = d.id),
c AS (SELECT *, seen / (SELECT count(*) FROM f) AS share FROM s), k AS (SELECT *, CASE WHEN share >= 0.95e0 THEN true WHEN share >= 0.9e0 THEN step % 10 = 0 ELSE step % 100 = 0 END AS checked FROM c)
SELECT id AS doc_id, step, seen, round(share, 6) AS coverage, checked, checked AND share >= 1 AS stops FROM k""",
    "G22_step_rates": "SELECT event_id, gap AS gap_us, round(1e6 / gap, 9) AS steps_per_second, round(8e6 / gap, 9) AS samples_per_second FROM (SELECT event_id, nullif(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS gap FROM events) z",
    "E7_retired": """WITH RECURSIVE o AS (SELECT user_id, value < 10 AS bad, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
s AS (SELECT user_id, i, CASE WHEN bad THEN 1 ELSE 0 END AS k, CASE WHEN bad THEN 1 ELSE 0 END AS longest FROM o WHERE i = 1 UNION ALL SELECT o.user_id, o.i, CASE WHEN o.bad THEN s.k + 1 ELSE 0 END, greatest(s.longest, CASE WHEN o.bad THEN s.k + 1 ELSE 0 END) FROM s JOIN o ON o.user_id = s.user_id AND o.i = s.i + 1)
SELECT user_id, CAST(max(longest) AS BIGINT) AS longest, max(longest) >= 3 AS retired FROM s GROUP BY user_id""",
}
