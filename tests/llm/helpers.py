"""Texts and comparisons that several tests share."""

import os
import sys

LONG = "wordy " * 60_000
SHARED = "the quick brown fox jumps over the lazy dog near the old river bank every single sunny day"
TOOLS = os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools")


def oracle_equal(spark, sf_dir, name):
    """Rows of a query and of its SQL, compared like the driver does."""
    import duckdb

    if TOOLS not in sys.path:
        sys.path.insert(0, TOOLS)
    from oracle_check import TABLES, digest

    from logwarden.llm.registry import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = QUERIES[name](spark, sf_dir)
    rel = con.sql(ORACLE_SQL[name])
    rows, want = [tuple(r) for r in df.collect()], rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(rel.columns, want)[0]
    return rows
