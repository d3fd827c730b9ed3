"""Distinct counts by bitmaps, Theil's U, ROC corners, rejected CSV lines, stratified split, projected rows."""
import datetime as dt
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecraft.operators import evaluate, impute, model, profile, relate, split
from scorecraft.plans import cleaning
from scorecraft.session import scratch_path
from scorecraft.sources import files


# ---------------------------------------------------------------- distinct counts
def test_distinct_counts_of_all_types(spark):
    base = dt.datetime(1969, 12, 31, 23, 59, 50)
    rows = [(k % 7 - 3, (k * 977) % 1000 - 500 if k % 11 else None, k % 2 == 0, dt.date(1960, 1, 1) + dt.timedelta(days=k % 40),
             base + dt.timedelta(seconds=k % 30), base + dt.timedelta(microseconds=k % 5), float(k % 3) * (-1 if k % 2 else 1), str(k % 13), None)
            for k in range(3000)] + [(-(2 ** 31), -(2 ** 63), None, None, None, None, -0.0, None, None), (2 ** 31 - 1, 2 ** 63 - 1, None, None, None, None, 0.0, "", None)]
    df = spark.createDataFrame(rows, "i int, l long, b boolean, d date, t timestamp, n timestamp_ntz, x double, s string, z long")
    got = {r["variable"]: (r["n_distinct"], r["n_null"]) for r in profile.unique_nulls(df, df.columns).collect()}
    for k, c in enumerate(df.columns):
        v = [r[k] for r in rows]
        assert got[c] == (len({x for x in v if x is not None}), sum(x is None for x in v)), c


def test_members_per_group(spark):
    rows = [(g, m) for g in ("a", "b", None) for m in (1, 1, 2, 70, -5, None)] + [("empty", None)]
    df = spark.createDataFrame(rows, "g string, m long")
    got = {r["g"]: r["n"] for r in profile.distinct_members(df, ["g"], "m", "n").collect()}
    assert got == {"a": 4, "b": 4, None: 4, "empty": 0}
    text = {r["g"]: r["n"] for r in profile.distinct_members(df.withColumn("m", F.col("m").cast("string")), ["g"], "m", "n").collect()}
    assert text == got
    assert {r["g"]: r["m_calc"] for r in impute.recount_per_group(df, "g", "m", None).collect()} == got


def test_bitmaps_shuffle_words_not_values(spark):
    """10,000 neighbouring values are under 200 words, combined before the shuffle."""
    df = spark.range(0, 10000, 1, 1).select(F.col("id").alias("v"))
    words = profile.count_distinct_whole(df, [], F.col("v"), F.lit(0))
    assert words.first()[0] == 10000
    plan = words._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan


# ---------------------------------------------------------------- association
def _theils_u(x, y):
    n, cells, of_x, of_y = len(x), Counter(zip(x, y)), Counter(x), Counter(y)
    h = -sum(c / n * math.log(c / n) for c in of_x.values())
    given = sum(c / n * math.log(of_y[b] / c) for (_, b), c in cells.items())
    return 1.0 if h == 0 else (h - given) / h


def test_theils_u_both_ways(spark):
    rows = [("p" if k % 3 else "q", str(k % 6), None if k % 5 else "w", "one") for k in range(600)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    got = {(r["v1"], r["v2"]): r["theils_u"] for r in relate.theils_u(df, ["a", "b", "c", "d"]).collect()}
    cols = {c: [r[k] or "null" for r in rows] for k, c in enumerate("abcd")}
    assert len(got) == 12
    for (x, y), u in got.items():
        assert u == pytest.approx(_theils_u(cols[x], cols[y]), abs=1e-12), (x, y)
    assert got["a", "b"] == pytest.approx(1.0) and got["b", "a"] < 1 and got["d", "a"] == 1.0


# ---------------------------------------------------------------- ROC
@pytest.mark.parametrize("rows_per_range", [10**6, 7])
def test_corners_keep_the_area(spark, rows_per_range, monkeypatch):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) * 0.5 + y * 0.3, 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    monkeypatch.setattr(evaluate.roc_points, "__defaults__", ("label", "score", rows_per_range))
    full = evaluate.roc_curve(df).orderBy(F.desc("threshold")).collect()
    few = evaluate.roc_curve(df, drop_collinear=True).orderBy(F.desc("threshold")).collect()
    want = [full[0]]
    for before, at, after in zip(full, full[1:], full[2:]):
        cross = (at.fpr - before.fpr) * (after.tpr - at.tpr) - (at.tpr - before.tpr) * (after.fpr - at.fpr)
        if abs(cross) > 1e-12:
            want.append(at)
    want.append(full[-1])
    assert [r.threshold for r in few] == [r.threshold for r in want] and len(few) < len(full)
    area = lambda p: sum((b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(p, p[1:]))
    assert area(few) == pytest.approx(area(full), abs=1e-12) == evaluate.auc(df).first()["auc"]


# ---------------------------------------------------------------- CSV
def test_rejected_lines(spark):
    path = scratch_path(spark, "lines")
    lines = ["k,x,d", "1,2.5,2020-01-01", "2,3.5", "3,4.5,2020-01-02,more", "4,many,2020-01-03", "5,,", '6,"7.5",2020-01-04', "7,1.0,not a day"]
    spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1).write.text(path)
    good, bad = files.read_csv_with_rejects(spark, path, "k int, x double, d date")
    assert sorted(r["k"] for r in good.collect()) == [1, 5, 6] and good.columns == ["k", "x", "d"]
    assert sorted(r["line"] for r in bad.collect()) == ["2,3.5", "3,4.5,2020-01-02,more", "4,many,2020-01-03", "7,1.0,not a day"]
    assert all(r["file"].startswith("part-") for r in bad.collect())


# ---------------------------------------------------------------- split
def test_a_class_of_one_key_is_split_exactly_over_ranges(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 3).alias("y"), F.lit("same").alias("k"), F.col("id").alias("v"))
    s = split.stratified_split(df, "y", ["k"])
    assert {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()} == {
        (y, p): n for y in (None, 1, 2) for p, n in (("train", 2250), ("valid", 750))}
    again = split.stratified_split(df.repartition(7), "y", ["k"])
    assert s.select("v", "split").exceptAll(again.select("v", "split")).count() == 0
    # no window takes a class whole
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    assert "__range" in plan[plan.index("row_number"):]


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.75, 1.0])
def test_split_fractions(spark, fraction):
    df = spark.range(1003).select((F.col("id") % 2).alias("y"), F.col("id").alias("k"))
    s = split.stratified_split(df, "y", ["k"], fraction).where("split = 'train'")
    assert {r["y"]: r["count"] for r in s.groupBy("y").count().collect()} == {
        y: n for y, n in ((0, math.floor(fraction * 502)), (1, math.floor(fraction * 501))) if n}


# ---------------------------------------------------------------- PCA and audit
def test_projected_rows_are_centred_scores(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3)) @ np.array([[3, 1, 0], [0, 1, 0.2], [0, 0, 0.5]]) + 50
    df = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(x)] + [(999, None, 1.0, 1.0)], "id long, `a.b` double, b double, c double")
    got = np.array([[r["pc1"], r["pc2"]] for r in model.pca_scores(df, ["a.b", "b", "c"], 2, keep=["id"]).orderBy("id").collect()])
    c = x - x.mean(axis=0)
    axes = np.linalg.eigh(c.T @ c)[1][:, ::-1][:, :2]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), range(2)])
    np.testing.assert_allclose(got, c @ axes, atol=1e-8)


def test_audit_counts_are_observed_not_scanned_for(spark, monkeypatch):
    written = []
    real = cleaning.staged
    monkeypatch.setattr(cleaning, "staged", lambda d, n: written.append(n) or real(d, n))
    df = spark.range(1200).select(
        F.col("id").alias("assessment_item_response_id"), *[F.col("id").alias(c) for c in cleaning.SPLIT_KEYS],
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("item_type_code_name"), (F.col("id") % 2).cast("double").alias("raw_score"),
        *[(F.col("id") % 50).cast("double").alias(d) for d in cleaning.DURATIONS],
        F.when(F.col("id") % 10 == 0, "[unassigned]").alias("response_correctness"),
        *[F.when(F.col("id") % 10 != 1, F.lit("2020-01-02").cast("timestamp")).alias(c) for c in ("student_start_datetime", "student_stop_datetime")],
        F.lit("2020-01-02").cast("timestamp").alias("item_attempt_start_datetime_utc"),
        F.when(F.col("id") % 10 == 2, F.lit("2020-01-01")).otherwise("2020-01-03").cast("timestamp").alias("item_attempt_end_datetime_utc"))
    rows = cleaning.audit_table(df).collect()
    assert {r["step"]: r["removed"] for r in rows if r["data"] == "all"} == {1: 120, 2: 120, 3: 120}
    assert {r["step"]: r["removed"] for r in cleaning.pre_split_audit(df).collect()} == {1: 120, 2: 120, 3: 120}
    assert written[0] == "audit"
