"""Connected components by alternating large-star and small-star steps; every step is a shuffle by node, written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the component's smallest node.

    No edges give no rows. Loops and repeated edges change nothing; edges with a
    null end are ignored.
    """
    cur = written(edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "cc")
    seen = None
    while True:
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).union(cur.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(large, "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        cur = written(small.where("u <> v").distinct().select(F.col("u").alias("a"), F.col("v").alias("b")), "cc")
        now = tuple(cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.xxhash64("b", "a") % 1_000_033)).first())
        if now == seen or now[0] == 0:
            break
        seen = now
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
