"""All queries of the engine's own operators and their SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from textloom.functions.dialect import Oracle, Spark
from textloom.operators import connectors, curation, dialogue, folds, knowledge, labels, learning, memory, passages, programs, recall, sequences, tables, text
from textloom.plans import ranking
from textloom.sources.parquet import TABLES, register
from textloom.streaming import streams

OPERATORS = text.QUERIES | tables.QUERIES | curation.QUERIES | memory.QUERIES
#: Beyond SQL, or with SQL of their own.
PROGRAMS = folds.PROGRAMS | programs.PROGRAMS | passages.PROGRAMS | curation.PROGRAMS | memory.PROGRAMS | streams.PROGRAMS | ranking.PROGRAMS | labels.QUERIES | dialogue.QUERIES | connectors.QUERIES | recall.QUERIES | learning.QUERIES | sequences.QUERIES | knowledge.QUERIES


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs an operator over the tables of a folder."""
    sql = OPERATORS[name](Spark())
    register(spark, sf_dir, [t for t in TABLES if re.search(rf"\b{t}\b", sql)])
    return spark.sql(sql)


def queries() -> dict:
    return {name: (lambda spark, sf_dir, name=name: run(name, spark, sf_dir)) for name in OPERATORS} | PROGRAMS


def oracle_sql() -> dict[str, str]:
    return {name: make(Oracle()) for name, make in OPERATORS.items()} | streams.ORACLE_SQL | programs.ORACLE_SQL | memory.ORACLE_SQL | passages.ORACLE_SQL | labels.ORACLE_SQL | dialogue.ORACLE_SQL | connectors.ORACLE_SQL | recall.ORACLE_SQL | sequences.ORACLE_SQL | knowledge.ORACLE_SQL
