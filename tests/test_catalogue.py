"""Every query with SQL against DuckDB over the same tables."""

import math

import duckdb
import pytest

from textloom.plans import catalogue
from textloom.sources.parquet import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return float(v) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    cols = sorted(df.columns)
    mine = sorted((tuple(plain(x) for x in r) for r in df.select(*cols).collect()), key=str)
    got = duck.execute(catalogue.oracle_sql()[name])
    at = [[c[0] for c in got.description].index(c) for c in cols]
    assert mine == sorted((tuple(plain(r[i]) for i in at) for r in got.fetchall()), key=str)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
