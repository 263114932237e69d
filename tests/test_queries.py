"""Every registered query with SQL gives DuckDB's rows on the small tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from cindermill.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return bool(value)
    if hasattr(value, "__float__") and not isinstance(value, str):
        return round(float(value), 4) + 0.0
    return str(value)[:19].removesuffix(" 00:00:00")


def rows(frame, columns):
    return sorted((tuple(plain(v) for v in r) for r in frame[columns].itertuples(index=False, name=None)), key=str)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    want = duck.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert rows(got, columns) == rows(want, columns)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
