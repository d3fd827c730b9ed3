"""Models against hand-written numpy oracles (no scipy/statsmodels/sklearn)."""

import math

import numpy as np
import pytest

from scorecraft.operators import model, stepwise
from scorecraft.operators.stats import t_two_sided_p


def _newton(x, y, iters=100):
    b = np.zeros(x.shape[1])
    for _ in range(iters):
        p = 1 / (1 + np.exp(-x @ b))
        h = (x * (p * (1 - p))[:, None]).T @ x
        step = np.linalg.solve(h, x.T @ (y - p))
        b += step
        if np.max(np.abs(step)) < 1e-12:
            break
    p = 1 / (1 + np.exp(-x @ b))
    h = (x * (p * (1 - p))[:, None]).T @ x
    ll = float(np.sum(y * np.log(p) + (1 - y) * np.log(1 - p)))
    return b, np.sqrt(np.diag(np.linalg.inv(h))), ll


@pytest.fixture(scope="module")
def logit_data(spark):
    rng = np.random.default_rng(7)
    n = 3000
    x1, x2, x3 = rng.normal(size=n), rng.normal(size=n), rng.normal(size=n)
    eta = -0.3 + 1.2 * x1 - 0.7 * x2
    y = (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(int)
    df = spark.createDataFrame([(float(a), float(b), float(c), int(t)) for a, b, c, t in zip(x1, x2, x3, y)],
                               "x1 double, x2 double, x3 double, target int")
    return df, np.column_stack([x1, x2, x3]), y


@pytest.mark.parametrize("solver", ["glr", "newton"])
def test_logit_matches_numpy_newton(spark, logit_data, solver):
    df, x, y = logit_data
    fit = model.logit_fit(df, ["x1", "x2", "x3"], "target", solver=solver)
    xb = np.column_stack([np.ones(len(y)), x])
    b, se, ll = _newton(xb, y)
    assert fit.terms == ["intercept", "x1", "x2", "x3"]
    np.testing.assert_allclose(fit.coef, b, atol=1e-6)
    np.testing.assert_allclose(fit.se, se, atol=1e-6)
    assert fit.ll == pytest.approx(ll, abs=1e-6)
    assert fit.aic == pytest.approx(-2 * ll + 8, abs=1e-5)
    assert fit.bic == pytest.approx(-2 * ll + 4 * math.log(len(y)), abs=1e-5)


def test_newton_engine_no_intercept(spark, logit_data):
    df, x, y = logit_data
    fit = model.newton_logit(df, ["x1", "x2"], "target", intercept=False)
    b, se, ll = _newton(x[:, :2], y)
    np.testing.assert_allclose(fit.coef, b, atol=1e-7)
    np.testing.assert_allclose(fit.se, se, atol=1e-7)


def test_l2_logistic_matches_penalised_newton(spark, logit_data):
    df, x, y = logit_data
    C = 0.01
    _, table = model.logit_l2(df, ["x1", "x2", "x3"], "target", C=C)
    got = {r["term"]: r["estimate"] for r in table.collect()}
    xb = np.column_stack([np.ones(len(y)), x])
    b = np.zeros(4)
    pen = np.diag([0.0, 1.0, 1.0, 1.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-xb @ b))
        g = C * xb.T @ (y - p) - pen @ b
        h = C * (xb * (p * (1 - p))[:, None]).T @ xb + pen
        b += np.linalg.solve(h, g)
    assert got["intercept"] == pytest.approx(b[0], abs=1e-4)
    assert got["x1"] == pytest.approx(b[1], abs=1e-4)


def test_ols_matches_lstsq(spark):
    rng = np.random.default_rng(11)
    n = 500
    x = rng.normal(size=(n, 2))
    y = 1.5 + x @ np.array([2.0, -1.0]) + rng.normal(size=n)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    fit = model.ols_fit(df, ["a", "b"], "y")
    xb = np.column_stack([np.ones(n), x])
    beta, *_ = np.linalg.lstsq(xb, y, rcond=None)
    resid = y - xb @ beta
    s2 = resid @ resid / (n - 3)
    se = np.sqrt(np.diag(s2 * np.linalg.inv(xb.T @ xb)))
    np.testing.assert_allclose(fit.coef, beta, atol=1e-9)
    np.testing.assert_allclose(fit.se, se, atol=1e-9)
    r2 = 1 - resid @ resid / np.sum((y - y.mean()) ** 2)
    assert fit.r2 == pytest.approx(r2, abs=1e-10)


def test_t_distribution():
    assert t_two_sided_p(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert t_two_sided_p(0.0, 5) == pytest.approx(1.0)


def test_forward_selection_picks_signal(spark, logit_data):
    df, _, _ = logit_data
    sel = stepwise.forward_selection(df, ["x3", "x2", "x1"], "target", "logistic", "aic", 0.05)
    assert sel.selected[0] == "intercept"
    assert set(sel.selected[1:]) == {"x1", "x2"}
    assert sel.selected[1] == "x1"  # strongest signal enters first


def test_backward_selection_drops_noise(spark, logit_data):
    df, _, _ = logit_data
    sel = stepwise.backward_selection(df, ["x1", "x2", "x3"], "target", "logistic", "aic", 0.05)
    assert "x3" not in sel.selected and {"x1", "x2"} <= set(sel.selected)


def test_linear_stepwise_from_one_gram(spark):
    rng = np.random.default_rng(5)
    n = 800
    x = rng.normal(size=(n, 3))
    y = 1 + 3 * x[:, 0] + rng.normal(size=n)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(x, y)],
                               "a double, b double, c double, y double")
    sel = stepwise.forward_selection(df, ["a", "b", "c"], "y", "linear", "bic", 0.05)
    assert sel.selected == ["intercept", "a"]


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3)) @ np.array([[2, 0, 0], [1, 1, 0], [0, 0, 0.2]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    t, _ = model.pca_variance(df, ["a", "b", "c"])
    got = [r["explained_variance_ratio"] for r in t.orderBy("component").collect()]
    ev = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    np.testing.assert_allclose(got, ev / ev.sum(), atol=1e-9)


def test_forward_without_criterion_enters_on_p(spark, logit_data):
    df, _, _ = logit_data
    a = stepwise.forward_selection(df, ["x3", "x2", "x1"], "target", "logistic", None, 0.05)
    b = stepwise.forward_selection(df, ["x3", "x2", "x1"], "target", "logistic", "r2", 0.05)  # r2: no use for logit
    assert a.selected == b.selected and set(a.selected[1:]) == {"x1", "x2"}
    assert all(act in ("entered", "break_significance") for act, *_ in a.log)


def test_backward_keep_intercept(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    n = 600
    x = rng.normal(size=(n, 2))
    y = 3 * x[:, 0] + rng.normal(size=n)  # true intercept 0: droppable unless kept
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(x, y)], "a double, b double, y double")
    free = stepwise.backward_selection(df, ["a", "b"], "y", "linear", "aic", 0.05)
    kept = stepwise.backward_selection(df, ["a", "b"], "y", "linear", "aic", 0.05, keep_intercept=True)
    assert "a" in free.selected and "a" in kept.selected
    assert "intercept" in kept.selected


def test_separation_is_flagged(spark):
    rows = [(float(x), int(x > 0)) for x in range(-20, 21) if x != 0]
    df = spark.createDataFrame(rows, "x double, target int")
    fit = model.newton_logit(df, ["x"], "target")
    assert not fit.converged
    stats = {r["statistic"]: r["value"] for r in fit.stats_frame(spark).collect()}
    assert stats["converged"] == 0.0


def _epoch_frame(spark, n=3000, seed=4):
    import numpy as np
    rng = np.random.default_rng(seed)
    z, w = rng.standard_normal(n), rng.standard_normal(n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.3 + z - 0.5 * w)))).astype(int)
    v = 2.0 + 3.0 * z + 0.7 * rng.standard_normal(n)
    rows = [(float(1.6e9 + 1e5 * a), float(a), float(b), int(t), float(u)) for a, b, t, u in zip(z, w, y, v)]
    return spark.createDataFrame(rows, "raw double, std double, w double, target int, v double")


def test_raw_scale_equals_standardised(spark):
    df = _epoch_frame(spark)
    for a, b in [(model.logit_fit(df, ["raw", "w"]), model.logit_fit(df, ["std", "w"])),
                 (model.ols_fit(df, ["raw", "w"], "v"), model.ols_fit(df, ["std", "w"], "v"))]:
        assert a.converged and abs(a.ll - b.ll) < 1e-6
        assert abs(a.coef[1] * 1e5 - b.coef[1]) < 1e-6 * abs(b.coef[1])
        assert abs(a.se[1] * 1e5 - b.se[1]) < 1e-6 * b.se[1] and abs(a.stat[2] - b.stat[2]) < 1e-5
        assert abs(a.p[1] - b.p[1]) <= 1e-4 * b.p[1]
    assert model.ols_fit(df, ["raw"], "v").r2 > 0.9
    glr = model.logit_fit(df, ["raw", "w"], solver="glr")
    newton = model.logit_fit(df, ["raw", "w"])
    assert abs(glr.ll - newton.ll) < 1e-6 and abs(glr.coef[1] - newton.coef[1]) < 1e-5 * abs(newton.coef[1])


def test_without_intercept_equals_glr(spark):
    df = _epoch_frame(spark)
    a, b = model.logit_fit(df, ["std", "w"], intercept=False), model.logit_fit(df, ["std", "w"], intercept=False, solver="glr")
    assert abs(a.ll - b.ll) < 1e-6 and max(abs(a.coef - b.coef)) < 1e-6


def test_aliased_terms_are_named(spark):
    df = _epoch_frame(spark).selectExpr("raw", "w", "target", "v", "raw * 2 + 5 AS twin", "raw - 3 * w AS both", "1.0 AS one")
    for fit in (model.logit_fit(df, ["raw", "twin", "w", "both", "one"]), model.ols_fit(df, ["raw", "twin", "w", "both", "one"], "v")):
        assert set(fit.aliased) == {"twin", "both", "one"}
        rows = {r.term: r for r in fit.coef_frame(spark).collect()}
        assert rows["twin"].estimate is None and rows["twin"].aliased and not rows["raw"].aliased
    alone = model.logit_fit(df, ["raw", "w"])
    full = model.logit_fit(df, ["raw", "twin", "w"])
    assert abs(alone.ll - full.ll) < 1e-9 and abs(alone.se[1] - full.se[1]) < 1e-9


def test_quasi_separation_is_flagged(spark):
    rows = [(float(x), int(x > 0)) for x in range(-20, 21) if x] + [(0.0, 0), (0.0, 1)]
    assert not model.logit_fit(spark.createDataFrame(rows, "x double, target int"), ["x"]).converged
