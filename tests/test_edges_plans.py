"""Edge frames (FIXTURES §5) and physical-plan assertions (pushdown, pruning,
broadcast, no Python UDF in hot paths)."""

import pytest
from pyspark.sql import functions as F

from scorecraft.operators import clean, distribution, encode, impute, profile, relate
from scorecraft.plans.catalog import load_all

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_empty_frame(spark):
    df = spark.createDataFrame([], "x double, c string, target int")
    assert distribution.iqr_fences(df, ["x"]).first()["q1"] is None
    assert profile.null_counts(df, ["x"]).first()["n_null"] == 0
    assert distribution.histogram(df, "x").count() == 0
    assert encode.woe_table(df, ["c"], "target").count() == 0


def test_all_null_and_constant_columns(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 1, "b")], "n int, k int, s string")
    got = {r["variable"]: r["value"] for r in profile.constant_columns(df, skip=None).collect()}
    assert got == {"n": "null", "k": "1"}


def test_woe_zero_event_and_null_category(spark):
    rows = [("a", 1), ("a", 0), ("b", 0), ("b", 0), (None, 1)]
    df = spark.createDataFrame(rows, "c string, target int")
    t = {r["category"]: r for r in encode.woe_table(df, ["c"], "target").collect()}
    assert t["b"]["n_good"] == 0 and t["b"]["good_dist"] == pytest.approx(0.5 / 2)
    assert t[None]["good_dist"] == pytest.approx(0.5 / 2)  # NULL category counted as 0 -> 0.5
    applied = encode.apply_woe(df, encode.woe_table(df, ["c"], "target"), ["c"])
    assert applied.where(F.col("c").isNull()).first()["c_woe"] is None


def test_swoe_inner_join_drops_null_category(spark):
    df = spark.createDataFrame([("a", 1), (None, 0), ("a", 0)], "c string, target int")
    assert encode.add_swoe(df, "c", "target", 24).count() == 2
    assert encode.add_swoe(df, "c", "target", 24, how="left").count() == 3


def test_anti_join_keeps_null_ids_and_removes_all_rows_of_bad_id(spark):
    rows = [(1, 5, 3), (1, 1, 2), (2, 1, 2), (None, 9, 1)]
    df = spark.createDataFrame(rows, "assessment_item_response_id int, s int, e int")
    out = clean.remove_bad_ids(df, F.col("e") < F.col("s"))
    ids = sorted((r[0] is None, r[0]) for r in out.collect())
    assert ids == [(False, 2), (True, None)]


def test_iqr_impute_null_flag_and_negative_kept(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100, -50]] + [(None,)], "x double")
    out = {r["x"]: r["x_imputed"] for r in impute.iqr_impute(df, ["x"]).collect()}
    assert out[None] is None and out[-50.0] is False and 3.0 in out and 100.0 not in out


def test_collapse_levels_other(spark):
    rows = [("a",)] * 90 + [("b",)] * 5 + [(None,)] * 5
    df = spark.createDataFrame(rows, "t string")
    got = {r["t"]: r["count"] for r in impute.collapse_levels(df, "t").groupBy("t").count().collect()}
    assert got == {"a": 90, "Other": 10}


def test_crosstab_total_vs_null(spark):
    df = spark.createDataFrame([("x", None), ("x", "u"), (None, "u")], "a string, b string")
    got = {(r["a"], r["b"]): r["count"] for r in relate.crosstab_margins(df, "a", "b").collect()}
    assert got[("Total", "Total")] == 3 and got[("null", "u")] == 1 and got[("x", "null")] == 1


def test_pushdown_and_pruning(spark):
    q = load_all()["before_cutoff"](spark, SF)
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan


def test_flagship_plan_is_jvm_only(spark):
    q = load_all()["prep_study"](spark, SF)
    plan = _plan(q)
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_size_checked_broadcast_falls_back(spark):
    from scorecraft.operators.joins import broadcast_if_small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(100).withColumnRenamed("id", "k")
        small = spark.range(10).withColumnRenamed("id", "k")
        j1 = big.join(broadcast_if_small(small, max_rows=100), "k")
        j2 = big.join(broadcast_if_small(small, max_rows=5), "k")
        j3 = big.join(broadcast_if_small(small, max_rows=100, max_bytes=100), "k")
        assert "BroadcastHashJoin" in _plan(j1)
        assert "BroadcastHashJoin" not in _plan(j2)
        assert "BroadcastHashJoin" not in _plan(j3)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_sized_join_null_keys_outside_shuffle(spark, how):
    from scorecraft.operators.joins import sized_join
    left = spark.createDataFrame([(None, 1)] * 5 + [("a", 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 10.0)], "k string, w double")
    small = sorted(map(tuple, sized_join(left, right, "k", how).collect()), key=repr)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = sized_join(left, right, "k", how, max_rows=0)
        assert sorted(map(tuple, big.collect()), key=repr) == small
        assert "BroadcastHashJoin" not in _plan(big)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert {"inner": 1, "left": 7, "left_anti": 6}[how] == len(small)
