"""Tables of a folder as views."""

from __future__ import annotations

from pyspark.sql import SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def register(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    """Makes temporary views of the named tables (all by default)."""
    for name in TABLES if names is None else names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
