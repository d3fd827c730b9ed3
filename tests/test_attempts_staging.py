"""How the attempts view is staged: what is shuffled and written, and that all of its rows
and columns come back (F1-F6 of FINDINGS_r03)."""

import datetime as dt
import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import scorecraft.sources.attempts  # noqa: F401
from scorecraft.plans import catalog
from scorecraft.plans.oracle import ATTEMPTS_CTE
from scorecraft.session import shuffle_partitions
from scorecraft.streaming import ingest

view = sys.modules["scorecraft.sources.attempts"]  # the package holds the function of that name

DAY = dt.datetime(2020, 1, 1)
SCHEMAS = {
    "lineitem": "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                "l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
    "customer": "c_custkey long, c_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "part": "p_partkey long, p_size int",
}


def _rows():
    """Keys that are null, repeat or have no match, and nulls in every other column."""
    null = lambda i, n, v: None if i % n == 0 else v
    lines = [(null(i, 41, i % 130), null(i, 43, i % 4), null(i, 37, i % 75), null(i, 31, i % 60), null(i, 29, float(i % 9)),
              null(i, 23, i * 1.25), null(i, 19, (i % 11) / 100), null(i, 7, "ARN"[i % 3]), null(i, 17, DAY + dt.timedelta(hours=i)))
             for i in range(1, 900)]
    orders = [(null(i, 50, i), null(i, 20, i % 70), null(i, 9, "FOP"[i % 3]), null(i, 13, DAY + dt.timedelta(days=i))) for i in range(1, 125)]
    customer = [(null(i, 33, i), null(i, 11, i % 6)) for i in range(66)]
    part = [(null(i, 35, i), null(i, 8, i % 50)) for i in range(70)]
    return {"lineitem": lines + lines[:40], "orders": orders + orders[:9], "customer": customer + customer[:5],
            "nation": [(i, i % 3) for i in range(5)] + [(None, 1)], "part": part + part[:6]}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    for name, rows in _rows().items():
        spark.createDataFrame(rows, SCHEMAS[name]).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


@pytest.fixture(scope="module")
def expected(tables):
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tables}/{name}.parquet/*.parquet')")
    rows = con.execute(f"WITH {ATTEMPTS_CTE} SELECT * FROM attempts").fetchall()
    assert len(rows) > 500
    return _sorted(rows)


def _sorted(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


def _collected(df):
    assert tuple(df.columns) == view.COLUMNS
    return _sorted(map(tuple, df.collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_staged_view_has_all_rows_and_columns(spark, tables, expected):
    assert _collected(catalog.att(spark, tables)) == expected
    assert _collected(view.attempts(spark, tables)) == expected


def test_lookups_beyond_the_bounds_give_the_same_rows(spark, tables, expected, monkeypatch):
    monkeypatch.setattr(view, "broadcast_if_small", lambda df: df)
    monkeypatch.setattr(view, "PARTITION_ROWS", 50)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(view.attempts(spark, tables))
        got = _collected(view.materialise_attempts(spark, tables, os.path.join(tables, "far")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert got == expected
    by_part = plan.index("hashpartitioning(l_partkey")
    assert "o_custkey" not in plan[by_part:plan.index("Scan parquet", by_part)]  # no column of orders on that way


def test_lineitem_is_shuffled_once_while_lookups_are_small(spark, tables):
    """Failed before: parts over Spark's own threshold sent the joined rows through a second shuffle."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(view.attempts(spark, tables))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "hashpartitioning(l_orderkey" in plan and "SortMergeJoin [l_orderkey" in plan
    assert "hashpartitioning(l_partkey" not in plan and "hashpartitioning(o_custkey" not in plan


def test_written_columns_are_those_nothing_else_yields(spark, tables):
    """Failed before: all 25 columns were written."""
    path = catalog.att_path(spark, tables)
    written = spark.read.parquet(path)
    assert set(written.columns) == set(view.COLUMNS) - set(view._derived())
    assert written.inputFiles() and all(".zstd." in f for f in written.inputFiles())
    plan = _plan(catalog.att(spark, tables).where(F.col("learner_attempt_status") == "fully scored").select("org_id"))
    assert "EqualTo(learner_attempt_status,fully scored)" in plan  # still pushed


def test_stream_reads_the_whole_view(spark, tables):
    stream = ingest.read_attempt_stream(spark, catalog.att_path(spark, tables))
    assert stream.isStreaming and tuple(stream.columns) == view.COLUMNS


def test_other_rows_stay_as_they_are(spark, tables):
    whole = view.attempts(spark, tables).withColumn("more", F.lit(1))
    assert view.attempts_view(whole) is whole
    some = spark.range(3)
    assert view.attempts_view(some) is some


def test_partitions_by_written_and_derived_columns(spark, tables, expected):
    m = view.materialise_attempts(spark, tables, os.path.join(tables, "parted"), partition_by=["org_id", "assessment_id"])
    assert _collected(m) == expected
    plan = _plan(m.where((F.col("org_id") == 1) & (F.col("assessment_id") == 3)))
    assert "PartitionFilters" in plan and "assessment_id" in plan.split("PartitionFilters")[1].split("]")[0]


def test_shuffle_partitions_grow_with_the_rows_and_are_put_back(spark, tables, monkeypatch):
    key, seen = "spark.sql.shuffle.partitions", []
    was = spark.conf.get(key)
    from scorecraft.sources import files
    staged = files.stage_parquet

    def spied(*a, **kw):
        seen.append(int(spark.conf.get(key)))
        return staged(*a, **kw)
    monkeypatch.setattr(files, "stage_parquet", spied)
    monkeypatch.setattr(view, "PARTITION_ROWS", 30)
    view.materialise_attempts(spark, tables, os.path.join(tables, "parts"))
    assert seen == [-(-939 // 30)] and spark.conf.get(key) == was
    with pytest.raises(ValueError):
        with shuffle_partitions(spark, 1):
            assert spark.conf.get(key) == was  # never fewer
            raise ValueError
    assert spark.conf.get(key) == was
