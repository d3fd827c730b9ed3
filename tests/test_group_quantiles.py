"""Quantiles of groups against numpy; imputation by many splits."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecraft.operators import group_quantiles as gq
from scorecraft.plans import cleaning

PROBS = (0.25, 0.5, 0.75)


def _check(df, got, keys, cols, value_filter=lambda v: True):
    rows = {}
    for r in df.collect():
        rows.setdefault(tuple(r[k] for k in keys), []).append(r)
    found = {tuple(r[k] for k in keys): r for r in got.collect()}
    assert set(found) == set(rows)
    for key, rs in rows.items():
        for c in cols:
            v = [float(r[c]) for r in rs if r[c] is not None and not np.isnan(r[c]) and value_filter(r[c])]
            for j, p in enumerate(PROBS):
                want = np.quantile(v, p) if v else None
                have = found[key][f"{c}_q{j}"]
                assert have is None if want is None else have == pytest.approx(want, rel=1e-12, abs=1e-12), (key, c, p)


@pytest.mark.parametrize("accuracy", [20, 2000])
def test_groups_of_all_sizes(spark, accuracy):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot").otherwise((F.sqrt("id").cast("int")).cast("string")).alias("g"),
        F.when(F.col("id") % 50 == 7, None).when(F.col("id") % 50 == 9, float("nan")).otherwise(F.sin("id") * 100).alias("a"),
        (F.col("id") % 7).alias("b"), F.when(F.col("id") % 3 == 1, F.lit(5.0)).alias("only.hot"))
    _check(df, gq.group_quantiles(df, ["g"], ["a", "b", "only.hot"], PROBS, accuracy=accuracy), ["g"], ["a", "b", "only.hot"])


def test_filter_two_keys_and_no_rows(spark):
    df = spark.range(4000).select((F.col("id") % 4).alias("g"), F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("h"), (F.cos("id") * 10).alias("a"))
    _check(df, gq.group_quantiles(df, ["g", "h"], ["a"], PROBS, lambda v: v >= 0), ["g", "h"], ["a"], lambda v: v >= 0)
    assert gq.group_quantiles(df.limit(0), ["g"], ["a"], PROBS).count() == 0


def test_a_bracket_over_many_tasks(spark, monkeypatch):
    """Brackets wider than a partition are read in parts, each with its offset."""
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(gq, "MAX_LEAF", 10)
    try:
        df = spark.range(20000).select(F.lit(1).alias("g"), F.sin("id").alias("a"))
        _check(df, gq.group_quantiles(df, ["g"], ["a"], PROBS, accuracy=4), ["g"], ["a"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    """With a sketch that lies, the groups concerned are read whole."""
    real = F.percentile_approx
    monkeypatch.setattr(gq.F, "percentile_approx", lambda c, fr, acc: F.transform(real(c, [0.0] * len(fr), acc), lambda x: x))
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.sin("id").alias("a"))
    _check(df, gq.group_quantiles(df, ["g"], ["a"], PROBS), ["g"], ["a"])


def _attempts(spark, n, split):
    return spark.range(n).select(
        split.alias("split"), F.element_at(F.array(F.lit("x"), F.lit("y"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("item_type_code_name"),
        (F.col("id") % 2).cast("int").alias("target"), *[(F.abs(F.sin(F.col("id") + k)) * F.when(F.col("id") % 97 == k, 1000).otherwise(1)).alias(d)
                                                         for k, d in enumerate(cleaning.DURATIONS)])


def test_a_null_split_is_a_split(spark):
    df = _attempts(spark, 3000, F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 4 == 1, "valid").otherwise("train"))
    got = cleaning.impute_by_split(df)
    assert got.count() == df.where("item_type_code_name IS NOT NULL").count()
    assert {r["split"] for r in got.select("split").distinct().collect()} == {None, "train", "valid"}
    own = cleaning.impute_split(df.where("split IS NULL"))
    cols = [*cleaning.DURATIONS, *[d + "_imputed" for d in cleaning.DURATIONS], "item_type_code_name_swoe"]
    agg = [F.sum(F.col(c).cast("double")).alias(c) for c in cols]
    a, b = got.where("split IS NULL").agg(*agg).first(), own.agg(*agg).first()
    assert [a[c] for c in cols] == pytest.approx([b[c] for c in cols]) and a[cols[3]] > 0


def test_ten_thousand_splits(spark):
    df = _attempts(spark, 60000, (F.col("id") % 10000).cast("string"))
    got = cleaning.impute_by_split(df)
    assert got.count() == 40000 and got.select("split").distinct().count() == 10000
