"""Regressions, components and selections whose results have a closed form, so that
plain SQL can state them: one binary covariate (the 2 x 2 table), two regressors,
two columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorecraft.operators import model, stepwise
from scorecraft.plans.catalog import att, query, rounded, tbl
from scorecraft.plans.oracle import STUDY_CTE, with_attempts
from scorecraft.plans.prep import study_frame

_TABLE = """t AS (SELECT count_if(x = 1 AND y = 1)::DOUBLE AS a, count_if(x = 1 AND y = 0)::DOUBLE AS b,
               count_if(x = 0 AND y = 1)::DOUBLE AS c, count_if(x = 0 AND y = 0)::DOUBLE AS d, count(*)::DOUBLE AS n FROM xy)"""
_XY = "xy AS (SELECT CASE WHEN item_type_code_name = 'multipleChoice' THEN 1 ELSE 0 END AS x, target AS y FROM study)"
_LL = "(a * ln(a / (a + b)) + b * ln(b / (a + b)) + c * ln(c / (c + d)) + d * ln(d / (c + d)))"
_LL0 = "((a + c) * ln((a + c) / n) + (b + d) * ln((b + d) / n))"
_COEFS = """SELECT 'intercept' AS term, round(ln(c / d), 6) AS estimate, round(sqrt(1 / c + 1 / d), 6) AS std_err, round(ln(c / d) / sqrt(1 / c + 1 / d), 6) AS stat FROM t
UNION ALL SELECT 'x', round(ln(a / b) - ln(c / d), 6), round(sqrt(1 / a + 1 / b + 1 / c + 1 / d), 6),
       round((ln(a / b) - ln(c / d)) / sqrt(1 / a + 1 / b + 1 / c + 1 / d), 6) FROM t"""


def _study_xy(spark, sf):
    x = F.when(F.col("item_type_code_name") == "multipleChoice", 1).otherwise(0)
    return study_frame(att(spark, sf)).select(x.alias("x"), F.col("target").alias("y"))


def _coefs(spark, fit):
    return rounded(fit.coef_frame(spark).select("term", "estimate", "std_err", "stat"))


@query("logit_binary", with_attempts(_COEFS, STUDY_CTE, _XY, _TABLE))
def q_logit_binary(spark, sf):
    """M1/M9: logistic regression on one binary covariate."""
    return _coefs(spark, model.logit_fit(_study_xy(spark, sf), ["x"], "y"))


@query("logit_binary_stats", with_attempts(f"""
SELECT 'n' AS statistic, round(n, 4) AS value FROM t UNION ALL SELECT 'log_likelihood', round({_LL}, 4) FROM t
UNION ALL SELECT 'll_null', round({_LL0}, 4) FROM t UNION ALL SELECT 'aic', round(4 - 2 * {_LL}, 4) FROM t
UNION ALL SELECT 'bic', round(2 * ln(n) - 2 * {_LL}, 4) FROM t UNION ALL SELECT 'pseudo_r_squared', round(1 - {_LL} / {_LL0}, 4) FROM t
UNION ALL SELECT 'converged', 1.0 FROM t""", STUDY_CTE, _XY, _TABLE))
def q_logit_binary_stats(spark, sf):
    """Model statistics of the same fit."""
    return rounded(model.logit_fit(_study_xy(spark, sf), ["x"], "y").stats_frame(spark), 4)


@query("logit_binary_no_intercept", with_attempts("""
SELECT 'x' AS term, round(ln(a / b), 6) AS estimate, round(sqrt(1 / a + 1 / b), 6) AS std_err, round(ln(a / b) / sqrt(1 / a + 1 / b), 6) AS stat FROM t
""", STUDY_CTE, _XY, _TABLE))
def q_logit_binary_no_intercept(spark, sf):
    """M2: without intercept."""
    return _coefs(spark, model.logit_fit(_study_xy(spark, sf), ["x"], "y", intercept=False))


@query("logit_labels_toxic", f"WITH xy AS (SELECT toxic AS x, quality AS y FROM labels), {_TABLE}\n{_COEFS}")
def q_logit_labels_toxic(spark, sf):
    """M1 on the labels table."""
    return _coefs(spark, model.logit_fit(tbl(spark, sf, "labels").select(F.col("toxic").alias("x"), F.col("quality").alias("y")), ["x"], "y"))


# Newton steps on the grouped table: minimise w^2 / 2 + sum(log loss), the intercept free
@query("logit_l2_binary", with_attempts("""
SELECT 'intercept' AS term, round(b0, 4) AS estimate FROM s WHERE k = 40 UNION ALL SELECT 'x', round(w, 4) FROM s WHERE k = 40""",
    STUDY_CTE, _XY, _TABLE, """s AS (
  SELECT 0 AS k, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS w
  UNION ALL
  SELECT k + 1, b0 - (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12), w - (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12)
  FROM (SELECT k, b0, w, (a + b) * p1 - a + (c + d) * p0 - c AS g1, (a + b) * p1 - a + w AS g2,
               (a + b) * p1 * (1 - p1) + (c + d) * p0 * (1 - p0) AS h11, (a + b) * p1 * (1 - p1) AS h12, (a + b) * p1 * (1 - p1) + 1 AS h22
        FROM (SELECT s.*, t.*, 1 / (1 + exp(-b0 - w)) AS p1, 1 / (1 + exp(-b0)) AS p0 FROM s, t WHERE k < 40) q) r)""").replace("WITH attempts", "WITH RECURSIVE attempts"))
def q_logit_l2_binary(spark, sf):
    """M3: L2-penalised logistic regression (C = 1) on one binary covariate."""
    return rounded(model.logit_l2(_study_xy(spark, sf), ["x"], "y", C=1.0)[1], 4)


_TWO = """m AS (SELECT count(*)::DOUBLE AS n, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, count(*) * var_pop(x) AS sxx, count(*) * var_pop(z) AS szz,
             count(*) * var_pop(y) AS syy, count(*) * covar_pop(x, z) AS sxz, count(*) * covar_pop(x, y) AS sxy, count(*) * covar_pop(z, y) AS szy FROM xz),
two AS (SELECT *, (sxy * szz - szy * sxz) / (sxx * szz - sxz * sxz) AS b1, (szy * sxx - sxy * sxz) / (sxx * szz - sxz * sxz) AS b2,
        sxx * szz - sxz * sxz AS det FROM m),
e AS (SELECT *, my - b1 * mx - b2 * mz AS b0, syy - b1 * sxy - b2 * szy AS sse FROM two),
f AS (SELECT *, sse / (n - 3) AS s2, sqrt(sse / (n - 3) * szz / det) AS e1, sqrt(sse / (n - 3) * sxx / det) AS e2,
        sqrt(sse / (n - 3) * (1 / n + (mx * mx * szz - 2 * mx * mz * sxz + mz * mz * sxx) / det)) AS e0,
        -n / 2 * (ln(2 * pi()) + ln(sse / n) + 1) AS ll2,
        sxy / sxx AS a1, sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx) AS se1, -n / 2 * (ln(2 * pi()) + ln((syy - sxy * sxy / sxx) / n) + 1) AS ll1,
        -n / 2 * (ln(2 * pi()) + ln(syy / n) + 1) AS ll0 FROM e)"""
_LINE = "xz AS (SELECT l_quantity AS x, l_discount AS z, l_extendedprice AS y FROM lineitem)"


@query("ols_two", f"""WITH {_LINE}, {_TWO}
SELECT 'intercept' AS term, round(b0, 4) AS estimate, round(e0, 4) AS std_err, round(b0 / e0, 4) AS stat FROM f
UNION ALL SELECT 'l_quantity', round(b1, 4), round(e1, 4), round(b1 / e1, 4) FROM f
UNION ALL SELECT 'l_discount', round(b2, 4), round(e2, 4), round(b2 / e2, 4) FROM f
UNION ALL SELECT 'r_squared', round(1 - sse / syy, 4), NULL, NULL FROM f
UNION ALL SELECT 'adj_r_squared', round(1 - (n - 1) / (n - 3) * sse / syy, 4), NULL, NULL FROM f
UNION ALL SELECT 'log_likelihood', round(ll2, 4), NULL, NULL FROM f
UNION ALL SELECT 'aic', round(6 - 2 * ll2, 4), NULL, NULL FROM f UNION ALL SELECT 'bic', round(3 * ln(n) - 2 * ll2, 4), NULL, NULL FROM f""")
def q_ols_two(spark, sf):
    """OLS on two regressors with standard errors, t and model statistics."""
    fit = model.ols_fit(tbl(spark, sf, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice")
    stats = fit.stats_frame(spark).where("statistic NOT IN ('n', 'converged')").select(F.col("statistic").alias("term"), F.col("value").alias("estimate"))
    return rounded(fit.coef_frame(spark).select("term", "estimate", "std_err", "stat").unionByName(stats, allowMissingColumns=True), 4)


@query("pca_two", """
WITH m AS (SELECT var_samp(l_quantity) AS a, var_samp(l_tax * 100) AS c, covar_samp(l_quantity, l_tax * 100) AS b FROM lineitem),
e AS (SELECT a + c AS total, (a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b * b) AS l1 FROM m)
SELECT 1 AS component, round(l1 / total, 6) AS explained_variance_ratio, round(l1 / total, 6) AS cumulative FROM e
UNION ALL SELECT 2, round(1 - l1 / total, 6), 1.0 FROM e""")
def q_pca_two(spark, sf):
    """M8: two columns, whose eigenvalues are the roots of a quadratic."""
    d = tbl(spark, sf, "lineitem").select("l_quantity", (F.col("l_tax") * 100).alias("tax"))
    return rounded(model.pca_variance(d, ["l_quantity", "tax"])[0])


# The label holds l_quantity; l_discount is noise or not.  Whichever holds, the rows
# follow from |t| against 1.96 (thousands of degrees of freedom) and the AIC.
_SUM = "xz AS (SELECT l_quantity AS x, l_discount AS z, l_extendedprice + 2000 * l_quantity AS y FROM lineitem)"


def _sum_frame(spark, sf):
    return tbl(spark, sf, "lineitem").withColumn("y", F.col("l_extendedprice") + 2000 * F.col("l_quantity"))


@query("forward_two", f"""WITH {_SUM}, {_TWO},
r AS (SELECT 2 * 1 - 2 * ll0 AS aic0, 2 * 2 - 2 * ll1 AS aic1, 2 * 3 - 2 * ll2 AS aic2, abs(a1 / se1) AS t1, abs(b2 / e2) AS t2 FROM f)
SELECT 1 AS step, 'entered' AS action, 'l_quantity' AS variable, round(aic1, 4) AS aic, round(aic1, 4) AS criterion FROM r WHERE t1 >= 1.96 AND aic1 < aic0
UNION ALL SELECT 2, CASE WHEN t2 < 1.96 THEN 'break_significance' WHEN aic2 < aic1 THEN 'entered' ELSE 'break_criterion' END,
       CASE WHEN t2 < 1.96 THEN NULL ELSE 'l_discount' END, CASE WHEN t2 < 1.96 THEN NULL ELSE round(aic2, 4) END,
       round(CASE WHEN t2 < 1.96 THEN aic1 ELSE aic2 END, 4) FROM r""")
def q_forward_two(spark, sf):
    """Linear forward selection from two candidates by AIC."""
    sel = stepwise.forward_selection(_sum_frame(spark, sf), ["l_quantity", "l_discount"], "y", "linear", "aic", 0.05)
    return rounded(sel.log_frame(spark).select("step", "action", "variable", "aic", "criterion"), 4)


@query("backward_two", f"""WITH {_SUM}, {_TWO},
r AS (SELECT 2 * 2 - 2 * ll1 AS aic1, 2 * 3 - 2 * ll2 AS aic2, abs(b2 / e2) >= 1.96 AS keep FROM f)
SELECT 1 AS step, CASE WHEN keep THEN 'final' ELSE 'eliminated' END AS action, CASE WHEN keep THEN NULL ELSE 'l_discount' END AS variable, round(aic2, 4) AS aic FROM r
UNION ALL SELECT 2, CASE WHEN aic2 < aic1 THEN 'regained' ELSE 'final' END, CASE WHEN aic2 < aic1 THEN 'l_discount' END, round(aic1, 4) FROM r WHERE NOT keep
UNION ALL SELECT 3, 'final', NULL, round(aic2, 4) FROM r WHERE NOT keep AND aic2 < aic1""")
def q_backward_two(spark, sf):
    """Linear backward elimination of two candidates by AIC, with regain."""
    sel = stepwise.backward_selection(_sum_frame(spark, sf), ["l_quantity", "l_discount"], "y", "linear", "aic", 0.05, keep_intercept=True)
    return rounded(sel.log_frame(spark).select("step", "action", "variable", "aic"), 4)


@query("pca_scores", """
WITH d AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, l_tax * 100 AS z FROM lineitem),
m AS (SELECT avg(x) AS mx, avg(z) AS mz, var_samp(x) AS a, var_samp(z) AS c, covar_samp(x, z) AS b FROM d),
e AS (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b * b) AS l1 FROM m),
v AS (SELECT mx, mz, (l1 - c) / sqrt(b * b + (l1 - c) ** 2) AS u1, b / sqrt(b * b + (l1 - c) ** 2) AS u2 FROM e),
w AS (SELECT mx, mz, u1 * CASE WHEN abs(u1) >= abs(u2) THEN sign(u1) ELSE sign(u2) END AS u1, u2 * CASE WHEN abs(u1) >= abs(u2) THEN sign(u1) ELSE sign(u2) END AS u2 FROM v)
SELECT l_orderkey, l_linenumber, round((x - mx) * u1 + (z - mz) * u2, 4) AS pc1,
       round(((z - mz) * u1 - (x - mx) * u2) * CASE WHEN abs(u1) >= abs(u2) THEN sign(u1) ELSE -sign(u2) END, 4) AS pc2 FROM d, w""")
def q_pca_scores(spark, sf):
    """M8: every row projected on both axes of two columns, whose eigenvectors have a closed form."""
    d = tbl(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", (F.col("l_tax") * 100).alias("tax"))
    return rounded(model.pca_scores(d, ["l_quantity", "tax"], keep=["l_orderkey", "l_linenumber"]), 4)


# A string column of three levels, of which the first is dropped: two 0/1 terms.  Both in, the
# model is saturated; one in, it is a 2 x 2 table; so every fit has a closed form.
_FLAGS = """xy AS (SELECT l_returnflag AS g, CASE WHEN l_discount > CASE l_returnflag WHEN 'R' THEN 0.03 ELSE 0.05 END THEN 1 ELSE 0 END AS y FROM lineitem),
c AS (SELECT count_if(g = 'A' AND y = 1)::DOUBLE AS s0, count_if(g = 'A' AND y = 0)::DOUBLE AS f0, count_if(g = 'N' AND y = 1)::DOUBLE AS s1,
             count_if(g = 'N' AND y = 0)::DOUBLE AS f1, count_if(g = 'R' AND y = 1)::DOUBLE AS s2, count_if(g = 'R' AND y = 0)::DOUBLE AS f2 FROM xy)"""


def _split_ll(*groups):
    """Log-likelihood of groups (successes, failures) with a rate each."""
    return " + ".join(f"(({s}) * ln(({s}) / ({s} + {f})) + ({f}) * ln(({f}) / ({s} + {f})))" for s, f in groups)


def _wald(s, f, t, g):
    return f"abs(ln(({s}) / ({f})) - ln(({t}) / ({g}))) / sqrt(1 / ({s}) + 1 / ({f}) + 1 / ({t}) + 1 / ({g}))"


# aic0, aic1, aic2, aic12 and |z| of each term alone (z1, z2) and beside the other (w1, w2)
_FLAG_FITS = f"""f AS (SELECT 2 - 2 * ({_split_ll(("s0 + s1 + s2", "f0 + f1 + f2"))}) AS aic0, 4 - 2 * ({_split_ll(("s1", "f1"), ("s0 + s2", "f0 + f2"))}) AS aic1,
  4 - 2 * ({_split_ll(("s2", "f2"), ("s0 + s1", "f0 + f1"))}) AS aic2, 6 - 2 * ({_split_ll(("s0", "f0"), ("s1", "f1"), ("s2", "f2"))}) AS aic12,
  {_wald("s1", "f1", "s0 + s2", "f0 + f2")} AS z1, {_wald("s2", "f2", "s0 + s1", "f0 + f1")} AS z2,
  {_wald("s1", "f1", "s0", "f0")} AS w1, {_wald("s2", "f2", "s0", "f0")} AS w2, 1.959963984540054 AS crit FROM c)"""


def _forward_log(a, b):
    """The log of a forward selection from two terms by AIC."""
    return f"""b AS (SELECT *, z1 >= z2 AS one, greatest(z1, z2) AS z, CASE WHEN z1 >= z2 THEN aic1 ELSE aic2 END AS best,
       CASE WHEN z1 >= z2 THEN w2 ELSE w1 END AS w FROM f)
SELECT 1 AS step, CASE WHEN z < crit THEN 'break_significance' WHEN best < aic0 THEN 'entered' ELSE 'break_criterion' END AS action,
       CASE WHEN z < crit THEN NULL WHEN one THEN '{a}' ELSE '{b}' END AS variable, CASE WHEN z >= crit THEN round(best, 4) END AS aic,
       round(CASE WHEN z < crit THEN aic0 ELSE best END, 4) AS criterion FROM b
UNION ALL SELECT 2, CASE WHEN w < crit THEN 'break_significance' WHEN aic12 < best THEN 'entered' ELSE 'break_criterion' END,
       CASE WHEN w < crit THEN NULL WHEN one THEN '{b}' ELSE '{a}' END, CASE WHEN w >= crit THEN round(aic12, 4) END,
       round(CASE WHEN w < crit THEN best ELSE aic12 END, 4) FROM b WHERE z >= crit AND best < aic0"""


def _backward_log(a, b):
    """The log of a backward elimination of two terms by AIC that keeps the intercept."""
    return f"""b AS (SELECT *, w1 < w2 AS one, least(w1, w2) AS w, CASE WHEN w1 < w2 THEN aic2 ELSE aic1 END AS rest, CASE WHEN w1 < w2 THEN z2 ELSE z1 END AS z FROM f),
p AS (SELECT *, w < crit AS gone, w < crit AND aic12 < rest AS back, w < crit AND NOT aic12 < rest AND z < crit AS empty FROM b)
SELECT 1 AS step, CASE WHEN gone THEN 'eliminated' ELSE 'final' END AS action, CASE WHEN NOT gone THEN NULL WHEN one THEN '{a}' ELSE '{b}' END AS variable,
       round(aic12, 4) AS aic FROM p
UNION ALL SELECT 2, CASE WHEN back THEN 'regained' WHEN empty THEN 'eliminated' ELSE 'final' END,
       CASE WHEN back AND one OR empty AND NOT one THEN '{a}' WHEN back OR empty THEN '{b}' END, round(rest, 4) FROM p WHERE gone
UNION ALL SELECT 3, CASE WHEN back THEN 'final' WHEN rest < aic0 THEN 'regained' ELSE 'final' END,
       CASE WHEN empty AND rest < aic0 THEN CASE WHEN one THEN '{b}' ELSE '{a}' END END, round(CASE WHEN back THEN aic12 ELSE aic0 END, 4) FROM p WHERE back OR empty
UNION ALL SELECT 4, 'final', NULL, round(rest, 4) FROM p WHERE empty AND rest < aic0"""


def _flags(spark, sf):
    flag = F.col("l_returnflag")
    return tbl(spark, sf, "lineitem").select(flag, (F.col("l_discount") > F.when(flag == "R", 0.03).otherwise(0.05)).cast("int").alias("y"))


@query("forward_logit_levels", f"WITH {_FLAGS}, {_FLAG_FITS}, {_forward_log('l_returnflag_N', 'l_returnflag_R')}")
def q_forward_logit_levels(spark, sf):
    """Logistic forward selection from the levels of a string column."""
    sel = stepwise.forward_selection(_flags(spark, sf), ["l_returnflag"], "y", "logistic", "aic", 0.05)
    return rounded(sel.log_frame(spark).select("step", "action", "variable", "aic", "criterion"), 4)


@query("backward_logit_levels", f"WITH {_FLAGS}, {_FLAG_FITS}, {_backward_log('l_returnflag_N', 'l_returnflag_R')}")
def q_backward_logit_levels(spark, sf):
    """Logistic backward elimination of the levels of a string column."""
    sel = stepwise.backward_selection(_flags(spark, sf), ["l_returnflag"], "y", "logistic", "aic", 0.05, keep_intercept=True)
    return rounded(sel.log_frame(spark).select("step", "action", "variable", "aic"), 4)
