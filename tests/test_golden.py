"""Golden fixtures taken from the study's own worked examples (FIXTURES §3)."""

import math

import pytest
from pyspark.sql import functions as F

from scorecraft.functions.text import initials_label
from scorecraft.operators import encode, profile
from scorecraft.operators.quantiles import quantile_values


def _rows(spark, spec, schema="cat string, target int"):
    rows = []
    for cat, n0, n1 in spec:
        rows += [(cat, 0)] * n0 + [(cat, 1)] * n1
    return spark.createDataFrame(rows, schema)


def test_g1_swoe(spark):
    df = _rows(spark, [("A", 28, 7), ("B", 16, 0), ("C", 94, 11), ("D", 23, 21)])
    got = {r["cat"]: r["cat_swoe"] for r in encode.swoe_table(df, "cat", "target", 24).collect()}
    exp = {"A": -1.3990550617101052, "B": -2.021151265806204, "C": -1.977829660040054, "D": -0.49954730872828346}
    for k, v in exp.items():
        assert got[k] == pytest.approx(v, abs=1e-12)


def test_g2_woe_iv(spark):
    cats = ["a", "b", "a", "b", "a", "a", "b", "c", "c"]
    ys = [1, 0, 0, 1, 0, 0, 1, 1, 0]
    df = spark.createDataFrame(list(zip(cats, ys)), "cat string, target int")
    t = encode.woe_table(df, ["cat"], "target", 1)
    got = {r["category"]: r["woe"] for r in t.collect()}
    assert got["a"] == pytest.approx(-0.8754687373538999, abs=1e-12)
    assert got["b"] == pytest.approx(0.9162907318741551, abs=1e-12)
    assert got["c"] == pytest.approx(0.22314355131420976, abs=1e-12)
    iv = encode.information_value(t).first()["iv"]
    assert iv == pytest.approx(0.5924584552018219, abs=1e-12)


def test_g4_sigmoid(spark):
    from scorecraft.operators.model import classify, score_by_coefficients
    df = spark.createDataFrame([(20.0,), (8.0,)], "x double")
    s = classify(score_by_coefficients(df, {"x": -0.54291739}, 8.19393897)).orderBy(F.desc("x")).collect()
    assert s[0]["score"] == pytest.approx(0.06510646, abs=1e-8)
    assert s[1]["score"] == pytest.approx(0.97917589, abs=1e-8)
    assert [r["prediction"] for r in s] == [0, 1]


def test_g5_quantile(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "x double")
    q = quantile_values(df, ["x"], [0.25, 0.5, 0.75])
    assert [q[("x", p)] for p in (0.25, 0.5, 0.75)] == [3.25, 5.5, 7.75]


def test_g6_months_between(spark):
    from scorecraft.functions.dates import null_sentinel
    df = spark.createDataFrame([("2020-01-31 00:00:00",)], "a string").select(F.col("a").cast("timestamp").alias("a"))
    v = df.select(F.months_between("a", F.lit("2020-03-15").cast("timestamp")).alias("m")).first()["m"]
    assert v == pytest.approx(-1.48387097, abs=1e-8)
    kept = df.select(null_sentinel("a", "2021-01-01 00:00:00").alias("x")).first()["x"]
    assert kept is not None
    gone = df.select(null_sentinel("a", "2999-01-01 00:00:00").alias("x")).first()["x"]
    assert gone is None


def test_g7_initials(spark):
    df = spark.createDataFrame([("Item Attempt",), ("Organization",)], "c string")
    assert [r[0] for r in df.select(initials_label(F.col("c"))).collect()] == ["(ia)", "(o)"]


def test_g8_except_distinct(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a int, b int")
    r = profile.except_report(df).first()
    assert r["incomplete_distinct"] == 1 and r["incomplete_rows"] == 2
    assert profile.subtract_incomplete(df).count() == 1


def test_information_value_sign(spark):
    df = _rows(spark, [("x", 10, 30), ("y", 30, 10)])
    iv = encode.information_value(encode.woe_table(df, ["cat"], "target", 1)).first()["iv"]
    assert iv > 0 and math.isfinite(iv)
