"""Writers of corpora: splits as JSON lines, memory tables with generations, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_splits(df: DataFrame, path: str, split: str = "split", gzip: bool = False) -> None:
    """One folder of JSON lines per split."""
    df.write.mode("overwrite").partitionBy(split).option("compression", "gzip" if gzip else "none").json(path)


def write_memory(df: DataFrame, path: str, generation: int) -> None:
    """A table's state as of a generation; earlier ones stay."""
    df.write.mode("overwrite").parquet(f"{path}/generation={generation}")


def append_log(df: DataFrame, path: str) -> None:
    """Rows as JSON lines added to a log."""
    df.write.mode("append").json(path)


