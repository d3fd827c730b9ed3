"""ROC/AUC against brute force (also with forced multi-range windows), metrics,
and the deterministic / stratified splits."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecraft.operators import evaluate, split


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(9)
    n = 2000
    y = rng.integers(0, 2, n)
    s = np.round(rng.random(n) * 0.6 + y * 0.3, 2)  # ties on purpose
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double"), y, s


def _brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    wins = sum(np.sum(p > neg) + 0.5 * np.sum(p == neg) for p in pos)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("rows_per_range", [1_000_000, 7])
def test_auc_matches_mann_whitney(spark, scored, rows_per_range):
    df, y, s = scored
    pts, P, N = evaluate.roc_points(df, "label", "score", rows_per_range=rows_per_range)
    got = pts.agg(F.sum(F.col("neg") * (2.0 * F.col("cum_pos") - F.col("pos")))).first()[0] / (2.0 * P * N)
    assert got == pytest.approx(_brute_auc(y, s), abs=1e-12)
    r = {row["score"]: (row["cum_pos"], row["cum_neg"]) for row in pts.collect()}
    for t in list(r)[:20]:
        assert r[t] == (int(np.sum((s >= t) & (y == 1))), int(np.sum((s >= t) & (y == 0))))


def test_roc_curve_endpoints(spark, scored):
    df, y, s = scored
    c = evaluate.roc_curve(df, "label", "score").collect()
    assert any(math.isinf(r["threshold"]) and r["fpr"] == 0 and r["tpr"] == 0 for r in c)
    assert max(r["tpr"] for r in c) == 1.0 and max(r["fpr"] for r in c) == 1.0


def test_metrics_and_report(spark):
    rows = [(1, 1)] * 5 + [(1, 0)] * 3 + [(0, 1)] * 2 + [(0, 0)] * 10
    df = spark.createDataFrame(rows, "label int, prediction int")
    m = evaluate.binary_metrics(df).first()
    assert (m["tp"], m["fn"], m["fp"], m["tn"]) == (5, 3, 2, 10)
    assert m["accuracy"] == pytest.approx(15 / 20)
    assert m["precision"] == pytest.approx(5 / 7) and m["recall"] == pytest.approx(5 / 8)
    rep = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert rep["1"]["f1"] == pytest.approx(2 * (5 / 7) * (5 / 8) / (5 / 7 + 5 / 8))
    assert rep["weighted avg"]["support"] == 20
    cm = {(r["label"], r["prediction"]): r["count"] for r in evaluate.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 10, (0, 1): 2, (1, 0): 3, (1, 1): 5}


def test_precision_zero_when_undefined(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    assert evaluate.binary_metrics(df).first()["precision"] == 0.0


def test_hash_split_deterministic(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = split.hash_split(df, ["k"]).where("split = 'train'").count()
    b = split.hash_split(df.repartition(13), ["k"]).where("split = 'train'").count()
    assert a == b and 0.7 < a / 5000 < 0.8


def test_xxhash_split_deterministic(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = split.hash_split(df, ["k"], method="xxhash64").where("split = 'train'").count()
    b = split.hash_split(df.repartition(7), ["k"], method="xxhash64").where("split = 'train'").count()
    assert a == b and 0.7 < a / 5000 < 0.8


def test_stratified_exact(spark):
    df = spark.range(1003).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    s = split.stratified_split(df, "y", ["k"])
    got = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    n1 = 1003 // 3 + 1
    n0 = 1003 - n1
    assert got[(1, "train")] == math.floor(0.75 * n1)
    assert got[(0, "train")] == math.floor(0.75 * n0)


@pytest.mark.parametrize("checkpoint", [False, True])
def test_native_split_partitions_rows(spark, checkpoint):
    df = spark.range(1000)
    tr, va = split.native_split(df, checkpoint=checkpoint)
    assert tr.count() + va.count() == 1000
    assert tr.join(va, "id").count() == 0
    assert split.native_sample(df, checkpoint=checkpoint).count() == split.native_sample(df, checkpoint=checkpoint).count()


def test_auc_matches_spark_ml_evaluator(spark, scored):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df, _, _ = scored
    ours = evaluate.auc(df, "label", "score").first()["auc"]
    ml = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName="areaUnderROC",
                                       numBins=0).evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert ours == pytest.approx(ml, abs=1e-9)


def test_small_fractions_are_not_cut(spark):
    df = spark.range(100_000).withColumnRenamed("id", "k")
    for f in (0.004, 0.016, 0.755):
        for method in ("md5", "xxhash64"):
            n = split.hash_sample(df, ["k"], f, method).count()
            assert abs(n - 100_000 * f) < 5 * math.sqrt(100_000 * f * (1 - f))


def test_stratified_with_ties_and_null_class(spark):
    rows = [(k % 2, "a", k) for k in range(400)] + [(k, None, k) for k in range(100)] + [(k, "b", k) for k in range(7)] + [(0, "c", 0)]
    df = spark.createDataFrame(rows, "k long, y string, v long")
    for parts in (1, 5):
        s = split.stratified_split(df.repartition(parts), "y", ["k"])
        assert s.columns == ["k", "y", "v", "split"] and s.count() == len(rows)
        got = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
        assert (got[("a", "train")], got[(None, "train")], got[("b", "train")]) == (300, 75, 5)
        assert ("c", "train") not in got


def test_stratified_ranks_only_the_bracket(spark):
    df = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") % 2).alias("y"))
    s = split.stratified_split(df, "y", ["k"])
    assert {r["count"] for r in s.where("split = 'train'").groupBy("y").count().collect()} == {75_000}
