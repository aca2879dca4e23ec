"""Driver contract: entry, registered queries and their DuckDB oracle at sf0.001."""

import os
import sys

import pytest

from conftest import ROOT, SMOKE, have_testdata

pytestmark = pytest.mark.skipif(not have_testdata(), reason="driver test data not present")

sys.path.insert(0, os.path.join(ROOT, "tools"))


def test_entry(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns[:3] == ["engine", "severity", "category"]
    assert df.count() >= 0


def test_every_query_has_columns(spark):
    from __spark_entry__ import oracle_sql
    from __spark_entry__ import queries as everything
    from logwarden.plans.registry import queries

    assert set(oracle_sql()) <= set(everything())
    qs = queries()
    for name, fn in qs.items():
        assert fn(spark, SMOKE).columns, name


def _names():
    sys.path.insert(0, ROOT)
    from logwarden.plans.registry import queries

    return sorted(queries())


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from oracle_check import TABLES

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", _names())
def test_oracle(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries
    from oracle_check import digest

    df = queries()[name](spark, SMOKE)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(rel.columns, drows)[0]
