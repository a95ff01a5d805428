"""Ranks and running sums over a whole table without a one-task window.

The table is sorted by ranges and written with each row's place in its range.
Only the ranges' totals (one row a range) are added up in one task and broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.sources.scratch import scratch


def _ranges(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Sorted rows with ``__at``: the range's number in the upper bits, the place in the range in the lower 33. ``order`` must be unique for repeatable results."""
    path = scratch(df.sparkSession, name)
    placed = df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id())
    placed.write.parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path).withColumn("__part", F.shiftright("__at", 33))


def _before(rows: DataFrame, total: Column) -> DataFrame:
    """(__part, __before): the sum over all earlier ranges, one row a range."""
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return rows.groupBy("__part").agg(total.alias("__t")).select("__part", F.coalesce(F.sum("__t").over(w), F.lit(0)).alias("__before"))


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds the rank from 1 over the whole table."""
    rows = _ranges(df, order, name)
    offsets = F.broadcast(_before(rows, F.count(F.lit(1))))  # one row a range
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(offsets, "__part").withColumn(name, F.col("__before") + place + 1).drop("__part", "__at", "__before")


def running_sum(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` up to and with each row."""
    rows = _ranges(df, order, name)
    offsets = F.broadcast(_before(rows, F.sum(value)))  # one row a range
    inside = F.sum(value).over(Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("__sum", inside).join(offsets, "__part").withColumn(name, F.col("__before") + F.col("__sum")).drop("__part", "__at", "__before", "__sum")


def split_blocks(df: DataFrame, key: str, score: str, blocks: int = 4, train: float = 0.8, validation: float = 0.1) -> DataFrame:
    """(key, split, block): blocks by falling score, shuffled inside by hash, then cut into splits. The last block takes the remainder."""
    ranked = global_rank(df.select(key, score), [F.desc(score), F.asc(key)], "r")
    n = F.broadcast(df.agg(F.count(F.lit(1)).alias("n")))  # one row
    block = F.least(F.floor((F.col("r") - 1) / F.greatest(F.floor(F.col("n") / blocks), F.lit(1))), F.lit(blocks - 1)).cast("long")
    placed = ranked.crossJoin(n).select(key, "n", block.alias("block"), F.md5(F.concat(F.lit("42:"), F.col(key).cast("string"))).alias("h"))
    cut = global_rank(placed, [F.asc("block"), F.asc("h"), F.asc(key)], "o")
    first = F.floor(F.lit(train) * F.col("n"))
    split = F.when(F.col("o") <= first, "train").when(F.col("o") <= first + F.floor(F.lit(validation) * F.col("n")), "validation").otherwise("test")
    return cut.select(key, split.alias("split"), "block")


def a5_splits(spark, sf_dir):
    return split_blocks(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "n_chars")


#: In place of the SQL of the same names, whose windows span the whole table.
PROGRAMS = {"A5_splits": a5_splits, }
