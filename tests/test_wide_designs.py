"""Cross-products and selections over many terms, against dense numpy."""
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecraft.operators import encode, model, stepwise
from scorecraft.operators.gram import Design, gram


def _dense(g):
    rows = [g.row(t) for t in [*range(len(g.names)), -1]]
    return np.array(rows)


def _centred(x):
    x = x - x.mean(axis=0)
    return x.T @ x


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(5)
    n = 4000
    g, h = rng.choice(list("abcd"), n, p=[0.5, 0.3, 0.15, 0.05]), rng.choice(["x", "y.z", None], n)
    a, b = rng.normal(size=n) + 1.6e9, rng.normal(size=n)
    y = (g == "b") * 2.0 + (h == "y.z") - 0.5 * b + rng.normal(size=n)
    rows = [(float(p), str(q), float(r), None if s is None else str(s), float(t)) for p, q, r, s, t in zip(a, g, b, h, y)]
    rows += [(None, "a", 1.0, "x", 1.0), (1.6e9, "a", float("nan"), "x", 1.0), (1.6e9, "b", 0.0, "x", None)]
    df = spark.createDataFrame(rows, "a double, g string, b double, h string, y double").repartition(5)
    cols = [a, g == "b", g == "c", g == "d", b, h == "x", h == "y.z"]
    return df, np.column_stack([*cols, y]).astype(float)


def test_numbers_and_levels_are_one_gram(spark, mixed):
    df, x = mixed
    d = Design(["a", "g", "b", "h"], {"g": ["b", "c", "d"], "h": ["x", "y.z"]})
    g = gram(d.rows(df, "y"), d)
    assert g.names == ["a", "g_b", "g_c", "g_d", "b", "h_x", "h_y.z"] and g.n == len(x)
    np.testing.assert_allclose(_dense(g), _centred(x), rtol=1e-9, atol=1e-5)
    np.testing.assert_allclose(g.mean, x.mean(axis=0), rtol=1e-12)
    np.testing.assert_allclose(g.diagonal(), np.diag(_centred(x)), rtol=1e-9)
    np.testing.assert_allclose(g.sub([4, 1]), _centred(x)[np.ix_([4, 1, 7], [4, 1, 7])], rtol=1e-9, atol=1e-6)


def _by_refits(x, names, y, backward=False):
    """Selections that fit every model from the rows."""
    def fit(terms):
        d = np.column_stack([np.ones(len(y))] + [x[:, names.index(t)] for t in terms])
        b, *_ = np.linalg.lstsq(d, y, rcond=None)
        r = y - d @ b
        s2 = r @ r / (len(y) - d.shape[1])
        t = b / np.sqrt(np.diag(np.linalg.inv(d.T @ d)) * s2)
        return np.abs(t), len(y) * np.log(r @ r / len(y)) + 2 * d.shape[1]
    if backward:
        now = list(names)
        while True:
            t, aic = fit(now)
            k = int(np.argmin(t[1:]))
            if t[1 + k] > 1.96:
                return now
            if fit(now[:k] + now[k + 1:])[1] > aic:
                return now
            now.pop(k)
    now = []
    aic = fit(now)[1]
    while len(now) < len(names):
        best = max((n for n in names if n not in now), key=lambda n: fit(now + [n])[0][-1])
        t, new = fit(now + [best])
        if t[-1] < 1.96 or new >= aic:
            break
        now, aic = now + [best], new
    return now


def test_selections_follow_from_the_gram(spark, mixed):
    df, x = mixed
    x, names = x.copy(), ["a", "g_b", "g_c", "g_d", "b", "h_x", "h_y.z"]
    x[:, 0] -= 1.6e9
    forward = stepwise.forward_selection(df, ["a", "g", "b", "h"], "y", "linear", "aic", strings="dummy_dropfirst")
    # h drops its first level; its NULL rows have no level, so h_x is no term
    want = _by_refits(x[:, [0, 1, 2, 3, 4, 6]], [n for n in names if n != "h_x"], x[:, -1])
    assert forward.selected[1:] == want
    back = stepwise.backward_selection(df, ["a", "g", "b", "h"], "y", "linear", "aic", strings="dummy", keep_intercept=True)
    assert "aliased" in {a for a, *_ in back.log}  # all four levels of g and the intercept
    assert {"g_b", "b", "h_y.z"} <= set(back.selected) | {"g_a"}


def test_two_hundred_columns_in_seconds(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 200))
    y = x[:, 3] * 2 - x[:, 150] + rng.normal(size=300)
    names = [f"c{k}" for k in range(200)]
    df = spark.createDataFrame([tuple(map(float, (*r, v))) for r, v in zip(x, y)], ", ".join(f"{n} double" for n in [*names, "y"])).cache()
    df.count()
    model.ols_fit(df, names[:2], "y")
    t = time.time()
    g = model.moments(df, names, "y")
    assert time.time() - t < 5
    np.testing.assert_allclose(g.products, _centred(np.column_stack([x, y])), rtol=1e-9, atol=1e-8)
    sel = stepwise.forward_selection(df, names, "y", "linear", "bic", 1e-6)
    assert sel.selected == ["intercept", "c3", "c150"] == ["intercept", *[n for n in _by_refits(x[:, [3, 150, 7]], ["c3", "c150", "c7"], y) if n != "c7"]]


def test_backward_sweeps_equal_refits(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 70))
    y = x[:, :5] @ np.array([1, -1, 0.5, 0.8, 0.3]) + rng.normal(size=2000)
    names = [f"c{k}" for k in range(70)]
    df = spark.createDataFrame([tuple(map(float, (*r, v))) for r, v in zip(x, y)], ", ".join(f"{n} double" for n in [*names, "y"]))
    sel = stepwise.backward_selection(df, names, "y", "linear", None, 0.05, keep_intercept=True)
    fit = model.ols_fit(df, [t for t in sel.selected if t != "intercept"], "y")
    assert len([a for a, *_ in sel.log if a == "eliminated"]) > 52  # past a fresh inverse
    for t in sel.selected:
        assert sel.final.coef[sel.final.terms.index(t)] == pytest.approx(fit.coef[fit.terms.index(t)], rel=1e-8)
        assert sel.final.se[sel.final.terms.index(t)] == pytest.approx(fit.se[fit.terms.index(t)], rel=1e-8)
    assert all(fit.pvalue(t) <= 0.05 for t in sel.selected if t != "intercept")


def test_five_thousand_levels(spark):
    n = 40000
    df = spark.range(n).select(F.format_string("v%04d", F.col("id") % 5000).alias("g"), F.sin("id").alias("x"),
                               (F.when(F.col("id") % 5000 == 17, 9).otherwise(0) + F.sin("id") + F.cos(F.col("id") * 7) / 10).alias("y"))
    sel = stepwise.forward_selection(df, ["g", "x"], "y", "linear", "bic", 1e-6)
    assert sel.selected[:3] in (["intercept", "x", "g_v0017"], ["intercept", "g_v0017", "x"])
    assert len(encode.dummy_levels(df, "g")) == 5000
    assert len(encode.dummy_columns(df.where("id % 5000 < 1200" if "id" in df.columns else "g < 'v1200'").select("g"), ["g"], "dummy").columns) == 1200


def test_logistic_terms_of_levels(spark):
    """Levels made in the tasks give what 0/1 columns give."""
    df = spark.range(3000).select(F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c"), F.lit(None)), (F.col("id") % 4 + 1).cast("int")).alias("g"),
                                  F.sin("id").alias("x"), (F.cos(F.col("id") * 7) + F.when(F.col("id") % 4 == 1, 0.6).otherwise(0) > 0.2).cast("int").alias("y"))
    coded = encode.dummy_columns(df, ["g"])
    a = stepwise.forward_selection(df, ["g", "x"], "y", "logistic", "aic", 0.05)
    b = stepwise.forward_selection(coded, ["g_b", "g_c", "x"], "y", "logistic", "aic", 0.05)
    assert a.selected == b.selected and "g_b" in a.selected
    np.testing.assert_allclose(a.final.coef, b.final.coef, rtol=1e-9)


def test_no_rows_and_clashing_names(spark):
    df = spark.createDataFrame([], "x double, y double")
    fit = model.ols_fit(df, ["x"], "y")
    assert fit.n == 0 and np.isnan(fit.coef[1])
    with pytest.raises(ValueError):
        Design(["g_x", "g"], {"g": ["x"]})
