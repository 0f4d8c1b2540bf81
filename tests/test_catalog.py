"""Every registered query with SQL gives what the SQL gives."""

import duckdb
import pytest
from helpers import SF
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clickloom.plans.catalog import QUERIES
from clickloom.plans.oracles import SQL

TABLES = "orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted(repr(tuple(r[i] for i in places)) for r in result.fetchall())
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == expected
    assert expected


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_closed_streams_leave_the_closing_row_out(spark):
    """The oracles of streams are those of whole tables; the reserved key is in no result."""
    for name in ("stream_window_event_count", "stream_ad_cap_out_of_order"):
        got = entry.queries()[name](spark, SF)
        key = "window_end_ms" if "window_end_ms" in got.columns else "user_id"
        assert got.where(F.col(key).isin(-1)).count() == 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
