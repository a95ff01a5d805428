"""The learning step over generations: clusters, calibrated co-occurrence, balanced hierarchies, smoothed counts.

Raking works over all cells of a table whose empty cells hold ``seed``: they
are factors of a row and a column and need no rows of their own. Tables of up to
LOCAL cells, rows and columns are raked on the driver; of larger ones every
round is a join that is written, so that lineage ends there.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.operators import labels
from textloom.operators.labels import stored

#: Cells, rows and columns together that are raked on the driver.
LOCAL = 1 << 20


def rake_arrays(a: np.ndarray, b: np.ndarray, n: np.ndarray, rows: np.ndarray, columns: np.ndarray, seed: float, tolerance: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors of rows and columns of the table that holds n + seed at (a, b) and seed elsewhere."""
    r, c = np.ones(len(rows)), np.ones(len(columns))
    for i in range(most):
        new = rows / (np.bincount(a, n * c[b], len(rows)) + seed * c.sum())
        if i and (not len(r) or np.abs(r / new - 1).max() < tolerance):
            break
        r = new
        c = columns / (np.bincount(b, n * r[a], len(columns)) + seed * r.sum())
    return r, c


def rake(rows: DataFrame, columns: DataFrame, cells: DataFrame, seed: float = 0.1, tolerance: float = 0.01, most: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Factors by which a table meets its goals: rows (a, goal, f), columns (b, goal, f) and the cells (a, b, n).

    The table's cell is (n + seed) times the factors of its row and column, n being
    0 where ``cells`` has none. Rows are met first, columns last, until the rows
    hold within ``tolerance`` or for ``most`` rounds.
    """
    at_least = F.greatest(F.col("goal").cast("double"), F.lit(0.1)).alias("goal")
    rows = stored(rows.select("a", at_least, F.lit(1.0).alias("f")), "rake-rows")
    columns = stored(columns.select("b", at_least, F.lit(1.0).alias("f")), "rake-columns")
    cells = stored(cells.select("a", "b", F.col("n").cast("double").alias("n")), "rake-cells")

    if rows.count() + columns.count() + cells.count() <= LOCAL:
        spark = rows.sparkSession
        left, right, held = (df.collect() for df in (rows.orderBy("a"), columns.orderBy("b"), cells))
        at = [{x[0]: i for i, x in enumerate(side)} for side in (left, right)]
        known = [x for x in held if x["a"] in at[0] and x["b"] in at[1]]
        goals = [np.array([x["goal"] for x in side], dtype=float) for side in (left, right)]
        r, c = rake_arrays(np.array([at[0][x["a"]] for x in known], dtype=np.int64), np.array([at[1][x["b"]] for x in known], dtype=np.int64), np.array([x["n"] for x in known], dtype=float), *goals, seed, tolerance, most)
        made = lambda df, key, side, goal, f: spark.createDataFrame([(x[0], float(g), float(v)) for x, g, v in zip(side, goal, f, strict=True)], df.select(key, "goal", "f").schema)
        return made(rows, "a", left, goals[0], r), made(columns, "b", right, goals[1], c), cells

    def fitted(side: DataFrame, key: str, other: DataFrame, by: str) -> DataFrame:
        total = other.agg(F.coalesce(F.sum("f"), F.lit(0.0))).first()[0]
        sums = cells.join(other.select(by, "f"), by).groupBy(key).agg(F.sum(F.col("n") * F.col("f")).alias("s"))
        return stored(side.join(sums, key, "left").select(key, "goal", F.col("f").alias("old"), (F.col("goal") / (F.coalesce("s", F.lit(0.0)) + seed * total)).alias("f")), "rake-fitted")

    for i in range(most):
        rows = fitted(rows, "a", columns, "b")
        off = rows.agg(F.max(F.abs(F.col("old") / F.col("f") - 1))).first()[0]
        if i and (off is None or off < tolerance):
            rows = rows.withColumn("f", F.col("old"))
            break
        columns = fitted(columns, "b", rows, "a")
    return rows.select("a", "goal", "f"), columns.select("b", "goal", "f"), cells


def calibrated(counts: DataFrame, pairs: DataFrame, seed: float = 0.1, **raking) -> DataFrame:
    """(a, b, n): co-occurrence scaled to the theme counts as both marginals, whole numbers; pairs that come to nothing keep their count, and pairs without one appear where they come to 1 or more."""
    r, c, cells = rake(counts.select(F.col("theme").alias("a"), F.col("n").alias("goal")), counts.select(F.col("theme").alias("b"), F.col("n").alias("goal")), pairs, seed, **raking)
    top = r.agg(F.max("f")).first()[0], c.agg(F.max("f")).first()[0]
    if top[0] is None:
        return pairs
    # Empty cells: only rows and columns of large factors can reach 1.
    bare = r.where(F.col("f") * top[1] * seed >= 1).select("a", F.col("f").alias("x")).crossJoin(c.where(F.col("f") * top[0] * seed >= 1).select("b", F.col("f").alias("y"))).where(F.col("x") * F.col("y") * seed >= 1)
    found = cells.unionByName(bare.select("a", "b", F.lit(0.0).alias("n"))).groupBy("a", "b").agg(F.max("n").alias("n")).where("a <> b")
    value = F.floor((F.col("n") + seed) * F.col("x") * F.col("y") + 1e-9).cast("long")
    found = found.join(r.select("a", F.col("f").alias("x")), "a").join(c.select("b", F.col("f").alias("y")), "b").withColumn("v", value)
    return found.select("a", "b", F.when(F.col("v") > 0, F.col("v")).otherwise(F.col("n").cast("long")).alias("n")).where("n > 0")


def clusters(counts: DataFrame, pairs: DataFrame, partners: int = 5, least: int = 3) -> DataFrame:
    """(cluster, theme): from the most frequent free theme on, a theme with its best partners that occur together ``least`` times or more.

    Partners are ranked in tasks; the driver goes through the themes that have any, one by one.
    """
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("n"), "b"))
    best = pairs.where(F.col("n") >= least).withColumn("rank", rank).where(F.col("rank") <= partners)
    best = best.groupBy(F.col("a").alias("theme")).agg(F.array_sort(F.collect_list(F.struct("rank", "b"))).alias("best"))
    seen, rows, cluster = set(), [], 0
    for r in best.join(counts, "theme").orderBy(F.desc("n"), "theme").toLocalIterator():
        if r["theme"] not in seen:
            members = [r["theme"]] + [x["b"] for x in r["best"]]
            seen.update(members)
            rows += [(cluster, m) for m in members]
            cluster += 1
    return counts.sparkSession.createDataFrame(rows, "cluster long, theme string")


def balanced(tree: DataFrame, counts: DataFrame, pairs: DataFrame, seed: float = 0.1, **raking) -> DataFrame:
    """(parent, child, weight): the hierarchy's links, raked to the counts of parents and children, as shares of the parent's count."""
    goal = lambda c: tree.select(F.col(c).alias("theme")).distinct().join(counts, "theme").select("theme", F.col("n").alias("goal"))
    cells = tree.select(F.col("parent").alias("a"), F.col("child").alias("b")).join(pairs, ["a", "b"], "left").select("a", "b", F.coalesce(F.col("n").cast("double"), F.lit(1.0)).alias("n"))
    r, c, cells = rake(goal("parent").withColumnRenamed("theme", "a"), goal("child").withColumnRenamed("theme", "b"), cells, seed, **raking)
    found = cells.join(r.select("a", "goal", F.col("f").alias("x")), "a").join(c.select("b", F.col("f").alias("y")), "b")
    return found.select(F.col("a").alias("parent"), F.col("b").alias("child"), ((F.col("n") + seed) * F.col("x") * F.col("y") / (F.col("goal") + 1e-8)).alias("weight"))


def smoothed(counts: DataFrame, found: DataFrame, seed: float = 0.1, **raking) -> DataFrame:
    """(theme, n): column sums of the table of clusters and themes after raking, as whole numbers, never below 1."""
    if found.isEmpty():
        return counts
    cells = found.join(counts, "theme").select(F.col("cluster").alias("a"), F.col("theme").alias("b"), "n").dropDuplicates(["a", "b"])
    width = counts.count()
    r, c, cells = rake(cells.groupBy("a").agg((F.sum("n") + seed * width).alias("goal")), counts.select(F.col("theme").alias("b"), F.col("n").alias("goal")), cells, seed, **raking)
    total = r.agg(F.sum("f")).first()[0]
    sums = cells.join(r.select("a", F.col("f").alias("x")), "a").groupBy("b").agg(F.sum(F.col("n") * F.col("x")).alias("s"))
    value = F.floor((F.coalesce("s", F.lit(0.0)) + seed * total) * F.col("f") + 1e-6).cast("long")
    return c.join(sums, "b", "left").select(F.col("b").alias("theme"), F.greatest(value, F.lit(1)).alias("n"))


def learn(found: DataFrame, prior: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """What a memory holds after a run's records: names, pairs, clusters, weights, tree, mutual. Raked where the memory has two themes or more."""
    names = stored(labels.count_names(found, prior and prior["names"]), "names")
    pairs = stored(labels.count_pairs(found, prior and prior["pairs"]), "pairs")
    counts = labels.themes_of(names)
    groups = stored(clusters(counts, pairs), "clusters")
    weights, tree = stored(labels.coherence_weights(counts, pairs), "weights"), stored(labels.hierarchy(counts, pairs), "tree")
    if counts.limit(2).count() == 2:
        pairs = stored(calibrated(counts, pairs), "calibrated")
        tree = stored(balanced(tree, counts, pairs), "balanced")
        counts = stored(smoothed(counts, groups), "smoothed")
    else:
        tree = tree.select("parent", "child", F.lit(1.0).alias("weight"))
    names = names.where("kind <> 'theme'").unionByName(counts.select(F.lit("theme").alias("kind"), F.col("theme").alias("name"), "n"))
    return {"names": stored(names, "names"), "pairs": pairs, "clusters": groups, "weights": weights, "tree": tree, "mutual": stored(labels.information(counts, pairs), "mutual")}


def generations(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A memory that learns from conversations, labels documents by what it knows, and learns from these."""
    first = learn(stored(labels.labelled(labels.candidates(labels.turns(spark, sf_dir))), "run-1"))
    known = labels.themes_of(first["names"]), first["pairs"], first["weights"], first["mutual"]
    second = labels.adaptive(stored(labels.candidates(labels.documents(spark, sf_dir)), "run-2"), *known)
    return learn(stored(second, "run-2"), first)


def _known(spark, sf_dir):
    found = labels.records(spark, sf_dir)
    return stored(labels.themes_of(labels.count_names(found)), "counts"), stored(labels.count_pairs(found), "pairs")


def g4_clusters(spark, sf_dir):
    return clusters(*_known(spark, sf_dir))


def g8_calibration(spark, sf_dir):
    """(kind, a, b, value): calibrated pairs, balanced hierarchy and smoothed counts."""
    counts, pairs = _known(spark, sf_dir)
    new = stored(calibrated(counts, pairs), "calibrated")
    tree = balanced(labels.hierarchy(counts, pairs), counts, new)
    flat = smoothed(counts, clusters(counts, pairs))
    rows = new.select(F.lit("pair").alias("kind"), "a", "b", F.col("n").cast("double").alias("value"))
    rows = rows.unionByName(tree.select(F.lit("hierarchy").alias("kind"), F.col("parent").alias("a"), F.col("child").alias("b"), F.round("weight", 6).alias("value")))
    return rows.unionByName(flat.select(F.lit("count").alias("kind"), F.col("theme").alias("a"), F.lit("").alias("b"), F.col("n").cast("double").alias("value")))


def b9_learn(spark, sf_dir):
    """(kind, a, b, value) of all that a memory holds after two generations."""
    m = generations(spark, sf_dir)
    parts = [
        m["names"].select("kind", F.col("name").alias("a"), F.lit("").alias("b"), F.col("n").cast("double").alias("value")),
        m["pairs"].select(F.lit("pair").alias("kind"), "a", "b", F.col("n").cast("double").alias("value")),
        m["clusters"].select(F.lit("cluster").alias("kind"), F.col("cluster").cast("string").alias("a"), F.col("theme").alias("b"), F.lit(1.0).alias("value")),
        m["weights"].select(F.lit("coherence").alias("kind"), F.col("theme").alias("a"), F.lit("").alias("b"), F.round("weight", 6).alias("value")),
        m["tree"].select(F.lit("hierarchy").alias("kind"), F.col("parent").alias("a"), F.col("child").alias("b"), F.round("weight", 6).alias("value")),
        m["mutual"].select(F.lit("information").alias("kind"), "a", "b", F.round("mi", 6).alias("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES = {"G4_clusters": g4_clusters, "G8_calibration": g8_calibration, "B9_learn": b9_learn}
