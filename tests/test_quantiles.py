"""The distributed rank search must equal numpy's linear-interpolation
quantiles, also when forced through several narrowing rounds."""

import numpy as np
import pytest

from scorecraft.operators import quantiles as Q


@pytest.mark.parametrize("max_leaf,buckets", [(1_000_000, 512), (40, 4), (7, 3)])
def test_exact_matches_numpy(spark, max_leaf, buckets):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 300, 2000).astype(float)      # many ties
    b = rng.normal(0, 1, 1500)                          # all distinct
    rows = [(float(x), float(y) if i < len(b) else None) for i, (x, y) in
            enumerate(zip(a, np.concatenate([b, np.zeros(len(a) - len(b))])))]
    df = spark.createDataFrame(rows, "a double, b double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = Q.quantile_values(df, ["a", "b"], probs, max_leaf=max_leaf, buckets=buckets)
    for p in probs:
        assert got[("a", p)] == pytest.approx(np.quantile(a, p), abs=1e-9)
        assert got[("b", p)] == pytest.approx(np.quantile(b, p), abs=1e-9)


def test_filter_and_empty(spark):
    df = spark.createDataFrame([(-5.0, None), (1.0, None), (2.0, None), (3.0, None)], "x double, y double")
    got = Q.quantile_values(df, ["x", "y"], [0.5], value_filter=lambda v: v >= 0)
    assert got[("x", 0.5)] == 2.0
    assert got[("y", 0.5)] is None


def test_approx_close(spark):
    rng = np.random.default_rng(1)
    x = rng.exponential(10, 5000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = Q.quantile_values(df, ["x"], [0.5], approx=True)
    assert got[("x", 0.5)] == pytest.approx(np.quantile(x, 0.5), rel=0.01)


def test_nan_is_skipped_like_null(spark):
    nan = float("nan")
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, nan, nan, nan, nan, None)], "x double")
    assert Q.quantile_values(df, ["x"], [0.5])[("x", 0.5)] == 2.5
    assert Q.quantile_values(df, ["x"], [0.5], value_filter=lambda v: v >= 0)[("x", 0.5)] == 2.5


@pytest.mark.parametrize("accuracy", [50, 400])
def test_only_brackets_leave_the_map_side(spark, accuracy, monkeypatch):
    """The shuffled frequency table holds the brackets' values, not the column."""
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, 6000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    sizes, real = [], Q._frequencies

    def counted(long, segs):
        freq = real(long, segs)
        sizes.append(freq.count())
        return freq
    monkeypatch.setattr(Q, "_frequencies", counted)
    got = Q.quantile_values(df, ["x"], [0.25, 0.5], max_leaf=10, buckets=4, accuracy=accuracy)
    assert got[("x", 0.25)] == pytest.approx(np.quantile(x, 0.25)) and got[("x", 0.5)] == pytest.approx(np.quantile(x, 0.5))
    assert sum(sizes) <= 2 * (7 / accuracy * 6000 + 5)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    df = spark.createDataFrame([(float(v),) for v in range(1000)], "x double")
    real = Q._frequencies
    calls = []

    def wrong(long, segs):
        calls.append(1)
        if len(calls) == 1:
            for s in segs:
                s["lo"] = s["hi"] = 900.0
        return real(long, segs)
    monkeypatch.setattr(Q, "_frequencies", wrong)
    assert Q.quantile_values(df, ["x"], [0.5], max_leaf=20, buckets=4)[("x", 0.5)] == 499.5 and len(calls) == 2
