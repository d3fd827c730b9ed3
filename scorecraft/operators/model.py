"""M1-M5, M8, M9: regression fits with inference tables, scoring, PCA.

Fitting runs on Spark: the logistic fits are Newton passes, Spark ML's IRLS (GLR)
and L-BFGS solvers, OLS is one pass producing the cross-products of the terms
(``gram``), PCA is Spark ML's distributed covariance.  Only coefficient-sized results
reach the driver, where the inference table (standard errors, tests,
intervals, LL/AIC/BIC/pseudo-R2) is assembled."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.operators import stats
from scorecraft.operators.gram import Design, Gram, gram
from scorecraft.operators.linalg import independent, inverse

INTERCEPT = "intercept"


@dataclass
class Fit:
    terms: list
    coef: np.ndarray
    se: np.ndarray
    stat: np.ndarray
    p: np.ndarray
    ci_low: np.ndarray
    ci_high: np.ndarray
    n: int
    ll: float
    ll_null: float | None
    aic: float
    bic: float
    r2: float | None = None
    r2_adj: float | None = None
    pseudo_r2: float | None = None
    kind: str = "logit"
    converged: bool = True
    aliased: tuple = ()

    def coef_frame(self, spark) -> DataFrame:
        """M1/M9: one row per term; an aliased term (a combination of terms before it)
        has NULL numbers; ``converged`` is false where the fit did not end."""
        rows = [(t, _f(b), _f(s), _f(z), _f(p), _f(lo), _f(hi), self.converged, t in self.aliased) for t, b, s, z, p, lo, hi in
                zip(self.terms, self.coef, self.se, self.stat, self.p, self.ci_low, self.ci_high)]
        return spark.createDataFrame(rows, "term string, estimate double, std_err double, stat double, p_value double, "
                                           "ci_low double, ci_high double, converged boolean, aliased boolean")

    def stats_frame(self, spark) -> DataFrame:
        """M10 model statistics in long form."""
        vals = [("n", float(self.n)), ("log_likelihood", self.ll), ("ll_null", self.ll_null), ("aic", self.aic),
                ("bic", self.bic), ("r_squared", self.r2), ("adj_r_squared", self.r2_adj),
                ("pseudo_r_squared", self.pseudo_r2), ("converged", 1.0 if self.converged else 0.0)]
        return spark.createDataFrame([(k, _f(v)) for k, v in vals if v is not None],
                                     "statistic string, value double")

    def criterion(self, name: str | None) -> float | None:
        return {"aic": self.aic, "bic": self.bic, "r2": self.r2, "adjr2": self.r2_adj}.get(name or "", None)

    def pvalue(self, term: str) -> float:
        return float(self.p[self.terms.index(term)])


def _f(v):
    if v is None:
        return None
    v = float(v)
    return None if math.isnan(v) else v


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without NULL or NaN; column names may hold dots."""
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        df = df.where(c.isNotNull() & ~F.isnan(c) if f.dataType.simpleString() in ("double", "float") else c.isNotNull())
    return df


def complete_cases(df: DataFrame, features, label) -> DataFrame:
    return drop_incomplete(df.select(*[F.col(f"`{c}`") for c in [*features, label]]))


def _assemble(df: DataFrame, features, label, out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=list(features), outputCol=out)
    return va.transform(complete_cases(df, features, label)).select(out, F.col(label).cast("double").alias(label))


def logit_fit(df: DataFrame, features, label: str = "target", intercept: bool = True,
              solver: str = "newton", max_iter: int = 100, tol: float = 1e-10) -> Fit:
    """M1/M2: maximum-likelihood logistic regression with the inference table.

    ``solver='newton'`` (default): the stepwise engine's Newton-Raphson on standardised
    columns, one pass over the rows per iteration; it names aliased terms and says
    whether it converged.  ``solver='glr'``: Spark ML's GeneralizedLinearRegression
    (binomial/logit IRLS), which neither does.  ``tests/test_models.py`` holds both to
    the same numbers on badly scaled columns."""
    if solver == "newton":
        return newton_logit(df, features, label, intercept)
    from pyspark.ml.regression import GeneralizedLinearRegression
    data = _assemble(df, features, label).persist(StorageLevel.MEMORY_AND_DISK)
    glr = GeneralizedLinearRegression(family="binomial", link="logit", regParam=0.0, fitIntercept=intercept,
                                      maxIter=max_iter, tol=tol, labelCol=label, featuresCol="features")
    m = glr.fit(data)
    s = m.summary
    k = len(features) + (1 if intercept else 0)
    coef = list(m.coefficients.toArray())
    try:
        se, zs, ps = list(s.coefficientStandardErrors), list(s.tValues), list(s.pValues)
    except Exception:  # noqa: BLE001 - the normal-equation solver fell back; use distributed Newton
        data.unpersist()
        return newton_logit(df, features, label, intercept)
    if intercept:  # summary arrays put the intercept last
        terms = [INTERCEPT] + list(features)
        coef = [m.intercept] + coef
        se, zs, ps = [se[-1]] + se[:-1], [zs[-1]] + zs[:-1], [ps[-1]] + ps[:-1]
    else:
        terms = list(features)
    n = int(s.numInstances)
    ll = -s.deviance / 2.0
    ll_null = -s.nullDeviance / 2.0
    coef, se = np.array(coef), np.array(se)
    data.unpersist()
    return Fit(terms, coef, se, np.array(zs), np.array(ps), coef - stats.Z_975 * se, coef + stats.Z_975 * se,
               n, ll, ll_null, -2 * ll + 2 * k, -2 * ll + k * math.log(n), pseudo_r2=1 - ll / ll_null,
               kind="logit")


def newton_logit(df: DataFrame, features, label: str = "target", intercept: bool = True) -> Fit:
    """M1/M2 by the distributed Newton engine (one pass per iteration)."""
    from scorecraft.operators.stepwise import LogisticEngine
    eng = LogisticEngine(df, Design(list(features)), label)
    try:
        design = ([INTERCEPT] if intercept else []) + list(features)
        return eng.fit_many([design])[0]
    finally:
        eng.close()


def logit_l2(df: DataFrame, features, label: str = "target", C: float = 1.0):
    """M3: L2-penalised logistic regression equivalent to 0.5*||w||^2 + C*sum(logloss)
    with a free intercept: MLlib minimises mean loss + lambda/2 ||w||^2, so
    lambda = 1 / (C * n) and no standardisation (Q29).  Returns (model, coef table)."""
    from pyspark.ml.classification import LogisticRegression
    data = _assemble(df, features, label).persist(StorageLevel.MEMORY_AND_DISK)
    n = data.count()
    lr = LogisticRegression(regParam=1.0 / (C * n), elasticNetParam=0.0, standardization=False,
                            fitIntercept=True, maxIter=500, tol=1e-10, labelCol=label, featuresCol="features")
    m = lr.fit(data)
    spark = df.sparkSession
    rows = [(INTERCEPT, float(m.intercept))] + [(f, float(b)) for f, b in zip(features, m.coefficients.toArray())]
    data.unpersist()
    return m, spark.createDataFrame(rows, "term string, estimate double")


@dataclass
class Solved:
    """Least squares on some terms: those that are used, the inverse of their cross-products
    and their slopes (intercept apart), and the sum of squares left."""
    terms: list
    used: list
    inv: np.ndarray
    slope: np.ndarray
    ssr: float


def moments(df: DataFrame, features, label) -> Gram:
    """Cross-products of number columns and the label over complete rows, in one pass."""
    design = Design(list(features))
    return gram(design.rows(df, label), design)


def solve(g: Gram, terms) -> Solved:
    """Slopes are solved on centred (with an intercept) columns."""
    at = [g.design.at[t] for t in terms if t != INTERCEPT]
    cross = g.sub(at)
    if INTERCEPT not in terms:
        mean = g.mean[[*at, -1]]
        cross = cross + g.n * np.outer(mean, mean)
    kept = independent(cross[:-1, :-1])
    inv = inverse(cross[np.ix_(kept, kept)]) if kept else np.zeros((0, 0))
    slope = inv @ cross[kept, -1]
    return Solved(list(terms), [g.names[at[k]] for k in kept], inv, slope, max(float(cross[-1, -1]) - float(cross[kept, -1] @ slope), 0.0))


def without(s: Solved, term: str) -> Solved:
    """The same fit less one term that is used (the sweep of one pivot)."""
    k = s.used.index(term)
    rest = [i for i in range(len(s.used)) if i != k]
    pivot = s.inv[rest, k] / s.inv[k, k]
    return Solved([t for t in s.terms if t != term], [s.used[i] for i in rest], s.inv[np.ix_(rest, rest)] - np.outer(pivot, s.inv[k, rest]),
                  s.slope[rest] - pivot * s.slope[k], s.ssr + float(s.slope[k] ** 2 / s.inv[k, k]))


def ols_of(g: Gram, s: Solved) -> Fit:
    """M5: the inference table; the intercept follows from the means."""
    terms, n, intercept = s.terms, g.n, INTERCEPT in s.terms
    mean, mean_y = g.mean[[g.design.at[t] for t in s.used]], float(g.mean[-1])
    yy = float(g.products[-1, -1]) + (0.0 if intercept else n * mean_y ** 2)
    ssr, k = s.ssr, len(s.used) + intercept
    df_resid = n - k
    sigma2 = ssr / df_resid if df_resid > 0 else float("nan")
    estimate, variance = dict(zip(s.used, s.slope)), dict(zip(s.used, np.diag(s.inv) * sigma2))
    if intercept:
        estimate[INTERCEPT] = mean_y - float(mean @ s.slope)
        variance[INTERCEPT] = sigma2 * (1.0 / n + float(mean @ s.inv @ mean)) if n else float("nan")
    beta = np.array([estimate.get(t, np.nan) for t in terms])
    se = np.sqrt(np.array([variance.get(t, np.nan) for t in terms]))
    with np.errstate(divide="ignore", invalid="ignore"):
        t = beta / se
    p = np.array([stats.t_two_sided_p(float(v), df_resid) for v in t])
    crit = stats.t_quantile_975(df_resid) if df_resid > 0 else float("nan")
    r2 = 1 - ssr / yy if yy > 0 else float("nan")
    r2_adj = 1 - (n - intercept) / df_resid * (1 - r2) if df_resid > 0 else float("nan")
    ll = -n / 2.0 * (math.log(2 * math.pi) + math.log(ssr / n) + 1) if ssr > 0 else float("inf")
    return Fit(terms, beta, se, t, p, beta - crit * se, beta + crit * se, n, ll, None,
               -2 * ll + 2 * k, -2 * ll + k * math.log(n) if n else float("nan"), r2=r2, r2_adj=r2_adj, kind="ols",
               aliased=tuple(x for x in terms if x not in estimate))


def ols_from_moments(g: Gram, terms) -> Fit:
    """M5: OLS for any subset of the terms, with or without the intercept."""
    return ols_of(g, solve(g, terms))


def ols_fit(df: DataFrame, features, label, intercept: bool = True) -> Fit:
    return ols_from_moments(moments(df, features, label), ([INTERCEPT] if intercept else []) + list(features))


def score_by_coefficients(df: DataFrame, coefs: dict, intercept: float, out: str = "score") -> DataFrame:
    """Probability from fixed coefficients (JVM-side expression)."""
    from scorecraft.functions.links import linear_predictor, sigmoid
    return df.withColumn(out, sigmoid(linear_predictor(coefs, intercept)))


def classify(df: DataFrame, score: str = "score", out: str = "prediction", threshold: float = 0.5) -> DataFrame:
    """M4: class = p > threshold (Q30)."""
    return df.withColumn(out, (F.col(score) > threshold).cast("int"))


def _pca(df: DataFrame, cols, k: int | None, keep=()):
    """(centred rows with ``keep`` and ``features``, Spark ML's model)."""
    from pyspark.ml.feature import PCA, VectorAssembler
    d = df.select(*[F.col(f"`{c}`").cast("double").alias(f"__x{i}") for i, c in enumerate(cols)], *[F.col(f"`{c}`") for c in keep])
    names = [f"__x{i}" for i in range(len(cols))]
    d = d.dropna(subset=names)
    means = d.agg(*[F.avg(c).alias(c) for c in names]).first()
    centred = d.withColumns({c: F.col(c) - F.lit(means[c]) for c in names})
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(centred).drop(*names)
    return rows, PCA(k=k or len(cols), inputCol="features", outputCol="pcs").fit(rows)


def pca_variance(df: DataFrame, cols, k: int | None = None):
    """M8: PCA on centred, unscaled columns (Q33).  Returns (ratios table,
    projected frame).  Means come from one aggregate; Spark ML computes the
    covariance distributedly; only k eigenvalues/vectors reach the driver."""
    rows, model = _pca(df, cols, k)
    cum, table = 0.0, []
    for i, v in enumerate(float(v) for v in model.explainedVariance.toArray()):
        cum += v
        table.append((i + 1, v, cum))
    return (df.sparkSession.createDataFrame(table, "component int, explained_variance_ratio double, cumulative double"),
            model.transform(rows).select("pcs"))


def pca_scores(df: DataFrame, cols, k: int | None = None, keep=()) -> DataFrame:
    """M8: the projected rows: columns ``keep`` and pc1 .. pck.  An axis has two directions; the
    one is taken in which its largest loading (the first of equals) is positive."""
    from pyspark.ml.functions import vector_to_array
    rows, model = _pca(df, cols, k, keep)
    axes = model.pc.toArray()
    largest = axes[np.argmax(np.abs(axes) > np.abs(axes).max(axis=0) * (1 - 1e-9), axis=0), np.arange(axes.shape[1])]
    pcs = vector_to_array("pcs")
    return model.transform(rows).select(*[F.col(f"`{c}`") for c in keep],
                                        *[(pcs[i] * F.lit(1.0 if v >= 0 else -1.0)).alias(f"pc{i + 1}") for i, v in enumerate(largest)])
