"""Every catalogue query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import oracle_check  # noqa: E402

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'America/Los_Angeles'")  # the oracle SQL must not depend on the zone
    for t in ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_key_has_a_docstring():
    for k, fn in QUERIES.items():
        assert fn.__doc__, k


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "swoe" in df.columns


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, duck, key):
    sdf = QUERIES[key](spark, SF)
    cols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(SQL[key])
    ok, msg = oracle_check.compare(srows, cols, cur.fetchall(), [d[0] for d in cur.description])
    assert ok, msg


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, key):
    assert QUERIES[key](spark, SF).count() > 0


def test_session_zone_does_not_change_results(spark, duck):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        sdf = QUERIES["offset_impute"](spark, SF)
        rows = [tuple(r) for r in sdf.collect()]
        cur = duck.execute(SQL["offset_impute"])
        ok, msg = oracle_check.compare(rows, sdf.columns, cur.fetchall(), [d[0] for d in cur.description])
        assert ok, msg
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
