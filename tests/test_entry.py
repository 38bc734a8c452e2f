"""The driver's contract: every query runs on the smallest tables; where there is SQL, columns agree."""

import duckdb
import pytest

import __spark_entry__ as entry
from quotewright.plans import queries as core

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query_matches_sql(spark, name):
    rows = core.QUERIES[name](spark, entry.SMALL)
    n = rows.count()
    if name not in core.ORACLE_SQL:
        return
    db = duckdb.connect()
    for t in TABLES.split():
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{entry.SMALL}/{t}.parquet'")
    want = db.sql(core.ORACLE_SQL[name])
    assert sorted(rows.columns) == sorted(want.columns)
    assert n == len(want.fetchall())


def test_sql_has_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
