"""Variants of the study's steps: cutoff pipeline, train-fitted imputation, offsets
fitted on a sample, month ticks, statistics over two frames, coded string columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorecraft.functions.dates import add_durations, epoch_micros
from scorecraft.operators import clean, distribution, impute, profile, split, stepwise
from scorecraft.plans import cleaning
from scorecraft.plans.catalog import att, query, rounded
from scorecraft.plans.oracle import STUDY_CTE, with_attempts
from scorecraft.plans.prep import ITEM_TYPE, study_frame
from scorecraft.plans.q_prep import _C1, _CLEAN_CTES, _D3, _filtered

_CUTOFF = "1996-01-01 00:00:00"


@query("clean_steps_cutoff", with_attempts("""
SELECT split, count(*) AS n_rows, CAST(sum(target) AS BIGINT) AS n_target FROM cl GROUP BY split""",
    *[c.replace("FROM attempts WHERE", f"FROM attempts WHERE item_attempt_start_datetime_utc < TIMESTAMP '{_CUTOFF}' AND") for c in _CLEAN_CTES]))
def q_clean_steps_cutoff(spark, sf):
    """K9 with C14 first: the cleaning pipeline on the attempts before a cutoff date."""
    d = add_durations(clean.keep_scored(clean.before_cutoff(att(spark, sf), "item_attempt_start_datetime_utc", _CUTOFF)))
    s = split.hash_split(cleaning.clean_before_split(d), cleaning.SPLIT_KEYS)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("target").cast("long").alias("n_target"))


_TRAIN_CTES = _CLEAN_CTES + [
    """swt AS (SELECT item_type_code_name, ln((count_if(target = 1) + 24 * p1) / (count_if(target = 0) + 24 * (1 - p1))) AS swoe
       FROM cl, (SELECT avg(target) AS p1 FROM cl WHERE split = 'train') WHERE split = 'train' GROUP BY item_type_code_name, p1)""",
    "j AS (SELECT cl.*, swt.swoe FROM cl JOIN swt ON cl.item_type_code_name = swt.item_type_code_name)",
    "fq AS (SELECT " + ", ".join(f"quantile_cont({c}, {p}) FILTER (WHERE {c} >= 0) AS {c}_q{k}" for c in _D3 for k, p in ((1, 0.25), (2, 0.5), (3, 0.75)))
    + " FROM j WHERE split = 'train')",
    "imp AS (SELECT j.split, j.swoe, " + ", ".join(
        f"j.{c} > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) AS {c}_imputed, CASE WHEN j.{c} > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) THEN {c}_q2 ELSE j.{c} END AS {c}"
        for c in _D3) + " FROM j, fq)"]


@query("train_fit_impute", with_attempts("SELECT split, count(*) AS n_rows, " + ", ".join(
    f"count_if({c}_imputed) AS n_{c}, round(avg({c}), 6) AS mean_{c}" for c in _D3)
    + ", round(avg(swoe), 6) AS mean_swoe FROM imp GROUP BY split", *_TRAIN_CTES))
def q_train_fit_impute(spark, sf):
    """K7 without leakage: SWOE and fences of both splits come from the training rows."""
    c = split.hash_split(cleaning.clean_before_split(_filtered(spark, sf)), cleaning.SPLIT_KEYS)
    c = c.select("split", ITEM_TYPE, "target", *cleaning.DURATIONS)
    d = cleaning.impute_split(c, fit_on=c.where("split = 'train'"))
    return rounded(d.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), *[a for x in _D3 for a in (F.count_if(F.col(x + "_imputed")).alias(f"n_{x}"), F.avg(x).alias(f"mean_{x}"))],
        F.avg("item_type_code_name_swoe").alias("mean_swoe")))


@query("sample_offset_impute", with_attempts("""
SELECT org_id, count_if(scored_datetime IS NULL) AS n_imputed, round(avg(CASE WHEN scored_datetime IS NULL
       THEN epoch(student_stop_datetime) + off ELSE epoch(scored_datetime) END) / 86400.0, 6) AS mean_day
FROM base, o GROUP BY org_id""", f"base AS (SELECT * FROM attempts WHERE {_C1})",
    """o AS (SELECT avg(epoch(scored_datetime) - epoch(student_stop_datetime)) AS off FROM base
       WHERE CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 13) AS BIGINT) / 4503599627370496.0 < 0.1)"""))
def q_sample_offset_impute(spark, sf):
    """K2 as in the study, the offset fitted on a 10 % sample (S1, by hash)."""
    d = impute.offset_impute(clean.keep_scored(att(spark, sf)), "scored_datetime", "student_stop_datetime",
                             flag="scored_datetime_imputed", sample_fraction=0.1, sample_keys=cleaning.SPLIT_KEYS)
    return rounded(d.groupBy("org_id").agg(F.count_if("scored_datetime_imputed").alias("n_imputed"),
                                           (F.avg(epoch_micros("scored_datetime")) / 86400e6).alias("mean_day")))


_DATES = ["item_attempt_start_datetime_utc", "student_stop_datetime", "assignment_due_date"]


@query("month_ticks", with_attempts("\nUNION ALL ".join(f"""
SELECT '{c}' AS variable, CAST(CAST(unnest(generate_series(date_trunc('month', min({c})), max({c}), INTERVAL 1 MONTH)) AS DATE) AS VARCHAR) AS tick FROM attempts"""
    for c in _DATES)))
def q_month_ticks(spark, sf):
    """Month-start ticks of the date axes."""
    return rounded(distribution.month_ticks(att(spark, sf), _DATES))


@query("compare_histograms", with_attempts("""
SELECT series, bin, count(*) AS count FROM (
  SELECT 'all' AS series, least(floor((raw_score - lo) / ((hi - lo) / 10)), 9)::INT AS bin FROM attempts, (SELECT min(raw_score) AS lo, max(raw_score) AS hi FROM attempts) WHERE raw_score IS NOT NULL
  UNION ALL SELECT 'scored', least(floor((raw_score - lo) / ((hi - lo) / 10)), 9)::INT FROM base, (SELECT min(raw_score) AS lo, max(raw_score) AS hi FROM base) WHERE raw_score IS NOT NULL)
GROUP BY 1, 2""", f"base AS (SELECT * FROM attempts WHERE {_C1})"))
def q_compare_histograms(spark, sf):
    """Histograms of one column over two frames."""
    a = att(spark, sf)
    out = profile.compare_frames({"all": a, "scored": clean.keep_scored(a)}, lambda d: distribution.histogram(d, "raw_score", 10))
    return out.where("count > 0").select("series", F.col("bin").cast("int").alias("bin"), "count")


def _exchange(m, p):
    """The matrix ``m`` (a list of rows) with pivot ``p`` swept in, or out if it was in."""
    whole = f"range(1, len({m}) + 1)"
    return (f"list_transform({whole}, lambda i: list_transform({whole}, lambda j: CASE WHEN i = {p} AND j = {p} THEN 1 / {m}[i][j] "
            f"WHEN i = {p} THEN {m}[i][j] / {m}[{p}][{p}] WHEN j = {p} THEN -{m}[i][j] / {m}[{p}][{p}] ELSE {m}[i][j] - {m}[i][{p}] * {m}[{p}][j] / {m}[{p}][{p}] END))")


_ITEM_CELLS = ["rows_ AS (SELECT item_type_code_name AS g, number_of_distinct_instance_items AS d, target AS y FROM study)",
    """tn AS (SELECT *, row_number() OVER (ORDER BY ord, g) AS k FROM (SELECT 'intercept' AS name, 1 AS ord, NULL AS g
       UNION ALL SELECT 'item_type_code_name_' || g, 2, g FROM (SELECT DISTINCT g FROM rows_ WHERE g IS NOT NULL ORDER BY g OFFSET 1) l
       UNION ALL SELECT 'number_of_distinct_instance_items', 3, NULL) t)"""]

# Logistic forward selection: the fit of every subset of the terms on grouped rows, by steps under a
# fixed bound of the curvature (a quarter of the cross-products), then the selection among them.
_ALL = "range(1, len(beta) + 1)"
_FORWARD = with_attempts("""
SELECT step, action, variable, round(aic, 4) AS aic, round(criterion, 4) AS criterion FROM (
  SELECT i + 1 AS step, CASE WHEN z IS NULL OR z < 1.959963984540054 THEN 'break_significance' WHEN new < aic THEN 'entered' ELSE 'break_criterion' END AS action,
         CASE WHEN z >= 1.959963984540054 THEN name END AS variable, CASE WHEN z >= 1.959963984540054 THEN new END AS aic,
         CASE WHEN z >= 1.959963984540054 THEN new ELSE aic END AS criterion
  FROM sel LEFT JOIN tn ON tn.k = sel.k WHERE i < (SELECT count(*) FROM tn) - 1) x""", STUDY_CTE, *_ITEM_CELLS,
    "cell AS (SELECT g, d, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS s FROM rows_ WHERE d IS NOT NULL AND y IS NOT NULL GROUP BY ALL)",
    """xs AS (SELECT c.g, c.d, any_value(n) AS n, any_value(s) AS s, list(CASE ord WHEN 1 THEN 1 WHEN 2 THEN coalesce(c.g = tn.g, false)::INT ELSE d END::DOUBLE ORDER BY k) AS x
       FROM cell c, tn GROUP BY c.g, c.d)""",
    "cells AS (SELECT list({'n': n, 's': s, 'x': x}) AS c, (SELECT count(*) FROM tn) AS w FROM xs)",
    "subsets AS (SELECT m AS mask, list_filter(range(1, w + 1), lambda k: k = 1 OR (m >> (k - 2)::INT) & 1 = 1) AS alive FROM cells, range(0, (1 << (w - 1)::INT)::BIGINT) r(m))",
    """quarter AS (SELECT list_transform(range(1, w + 1), lambda i: list_transform(range(1, w + 1), lambda j: list_sum(list_transform(c, lambda e: e.n * e.x[i] * e.x[j] / 4)))) AS m
       FROM cells)""",
    f"""inv AS (SELECT mask, alive, 1::BIGINT AS pos, m FROM subsets, quarter
       UNION ALL SELECT mask, alive, pos + 1, {_exchange("m", "alive[pos]")} FROM inv WHERE pos <= len(alive))""",
    "bound AS (SELECT mask, alive, m FROM inv WHERE pos > len(alive))",
    f"""it AS (SELECT mask, 0 AS t, list_transform(range(1, w + 1), lambda k: 0.0::DOUBLE) AS beta, 1.0::DOUBLE AS moved FROM subsets, cells
       UNION ALL SELECT mask, t + 1, list_transform({_ALL}, lambda k: beta[k] + step[k]), list_max(list_transform(step, lambda v: abs(v))) FROM (
         SELECT mask, t, beta, list_transform({_ALL}, lambda k: CASE WHEN list_contains(alive, k) THEN list_sum(list_transform(alive, lambda j: m[k][j] * grad[j])) ELSE 0 END) AS step FROM (
           SELECT it.mask, t, beta, alive, m, list_transform({_ALL}, lambda k: list_sum(list_transform(c, lambda e: e.x[k] * (e.s - e.n / (1 + exp(-list_dot_product(e.x, beta))))))) AS grad
           FROM it JOIN bound ON bound.mask = it.mask, cells WHERE t < 400 AND moved > 1e-8) q) r)""",
    "ended AS (SELECT mask, arg_max(beta, t) AS beta FROM it GROUP BY mask)",
    f"""h AS (SELECT mask, beta, list_transform({_ALL}, lambda i: list_transform({_ALL}, lambda j:
         list_sum(list_transform(c, lambda e: e.n * e.x[i] * e.x[j] / ((1 + exp(-list_dot_product(e.x, beta))) * (1 + exp(list_dot_product(e.x, beta)))))))) AS m FROM ended, cells)""",
    f"""cov AS (SELECT h.mask, beta, alive, 1::BIGINT AS pos, m FROM h JOIN subsets ON subsets.mask = h.mask
       UNION ALL SELECT mask, beta, alive, pos + 1, {_exchange("m", "alive[pos]")} FROM cov WHERE pos <= len(alive))""",
    """fits AS (SELECT mask, beta, m, 2 * len(alive) - 2 * list_sum(list_transform(c, lambda e: e.s * list_dot_product(e.x, beta) - e.n * ln(1 + exp(list_dot_product(e.x, beta))))) AS aic
       FROM cov, cells WHERE pos > len(alive))""",
    """tries AS (SELECT f.mask AS now, k, g.aic AS new, abs(g.beta[k]) / sqrt(g.m[k][k]) AS z FROM fits f, tn JOIN fits g ON g.mask = f.mask | (1 << (k - 2)::INT)
       WHERE k > 1 AND (f.mask >> (k - 2)::INT) & 1 = 0)""",
    "best AS (SELECT now, arg_max({'k': k, 'new': new, 'z': z}, z - k * 1e-9) AS b FROM tries GROUP BY now)",
    """sel AS (SELECT 0 AS i, mask, aic, b.k AS k, b.new AS new, b.z AS z FROM fits LEFT JOIN best ON now = mask WHERE mask = 0
       UNION ALL SELECT i + 1, n.mask, n.aic, n.k, n.new, n.z FROM sel JOIN (SELECT mask, aic, b.k AS k, b.new AS new, b.z AS z FROM fits LEFT JOIN best ON now = mask) n
         ON n.mask = sel.mask | (1 << (sel.k - 2)::INT) WHERE sel.z >= 1.959963984540054 AND sel.new < sel.aic)""").replace("WITH attempts", "WITH RECURSIVE attempts")


@query("stepwise_forward_dummies", _FORWARD)
def q_stepwise_forward_dummies(spark, sf):
    """M6 with L5: logistic forward selection over a string column's levels and a number."""
    s = study_frame(att(spark, sf)).select(ITEM_TYPE, "number_of_distinct_instance_items", "target")
    sel = stepwise.forward_selection(s, [ITEM_TYPE, "number_of_distinct_instance_items"], "target", "logistic", "aic", 0.05)
    return rounded(sel.log_frame(spark).select("step", "action", "variable", "aic", "criterion"), 4)


# Backward elimination by sweeps of the cross-products of (intercept, levels but the first, number,
# label): a state per model, whose least |t| goes while it is under 1.96 and the AIC is no worse.
_BACKWARD = with_attempts(f"""
SELECT row_number() OVER (ORDER BY i, o) AS step, action, variable, round(aic, 4) AS aic, round(aic, 4) AS criterion FROM (
  SELECT i, 1 AS o, CASE WHEN worse THEN 'regained' ELSE 'eliminated' END AS action, name AS variable, aic
  FROM judged JOIN tn ON tn.k = CASE WHEN worse THEN gone ELSE drop END WHERE worse OR least < 1.959963984540054
  UNION ALL SELECT i, 2, 'final', NULL, CASE WHEN worse THEN before ELSE aic END FROM judged WHERE i = (SELECT max(i) FROM judged)) x""", STUDY_CTE,
    "rows_ AS (SELECT item_type_code_name AS g, number_of_distinct_instance_items AS d, target AS y FROM study)",
    "cells AS (SELECT g, d, y, count(*)::DOUBLE AS n FROM rows_ WHERE d IS NOT NULL AND y IS NOT NULL GROUP BY ALL)",
    """tn AS (SELECT *, row_number() OVER (ORDER BY ord, g) AS k FROM (SELECT 'intercept' AS name, 1 AS ord, NULL AS g
       UNION ALL SELECT 'item_type_code_name_' || g, 2, g FROM (SELECT DISTINCT g FROM rows_ WHERE g IS NOT NULL ORDER BY g OFFSET 1) l
       UNION ALL SELECT 'number_of_distinct_instance_items', 3, NULL UNION ALL SELECT 'y', 4, NULL) t)""",
    """val AS (SELECT k, cells.g, d, y, n, CASE ord WHEN 1 THEN 1 WHEN 2 THEN coalesce(cells.g = tn.g, false)::INT WHEN 3 THEN d ELSE y END::DOUBLE AS v FROM cells, tn)""",
    """mm AS (SELECT a.k AS i, b.k AS j, sum(a.n * a.v * b.v) AS s FROM val a JOIN val b ON a.g IS NOT DISTINCT FROM b.g AND a.d = b.d AND a.y = b.y GROUP BY 1, 2)""",
    "mat AS (SELECT list(r ORDER BY i) AS m, len(list(r)) AS w, (SELECT sum(n) FROM cells) AS n FROM (SELECT i, list(s ORDER BY j) AS r FROM mm GROUP BY i) q)",
    f"sw AS (SELECT 0::BIGINT AS k, m, w, n FROM mat UNION ALL SELECT k + 1, {_exchange('m', '(k + 1)')}, w, n FROM sw WHERE k + 1 < w)",
    f"""back AS (SELECT 0 AS i, m, w, n, range(1, w) AS alive, NULL::DOUBLE AS before, 0::BIGINT AS gone FROM sw WHERE k + 1 = w
       UNION ALL SELECT i + 1, {_exchange('m', 'drop')}, w, n, list_filter(alive, lambda x: x <> drop), aic, drop
       FROM (SELECT *, alive[list_position(t, list_min(t))] AS drop FROM (SELECT *, list_min(t) AS least FROM (
         SELECT *, list_transform(alive, lambda x: abs(m[x][w]) / sqrt(m[w][w] / (n - len(alive)) * m[x][x])) AS t,
                2 * len(alive) + n * (ln(2 * pi()) + ln(m[w][w] / n) + 1) AS aic FROM back) a) b) c
       WHERE least < 1.959963984540054 AND (before IS NULL OR aic <= before) AND i + 2 < w)""",
    """judged AS (SELECT *, alive[list_position(t, list_min(t))] AS drop, list_min(t) AS least, before IS NOT NULL AND before < aic AS worse FROM (
         SELECT *, list_transform(alive, lambda x: abs(m[x][w]) / sqrt(m[w][w] / (n - len(alive)) * m[x][x])) AS t,
                2 * len(alive) + n * (ln(2 * pi()) + ln(m[w][w] / n) + 1) AS aic FROM back) a)""").replace("WITH attempts", "WITH RECURSIVE attempts")


@query("stepwise_backward_dummies", _BACKWARD)
def q_stepwise_backward_dummies(spark, sf):
    """M7 with L5: linear backward elimination over a string column's levels and a number."""
    s = study_frame(att(spark, sf)).select(ITEM_TYPE, "number_of_distinct_instance_items", "target")
    sel = stepwise.backward_selection(s, [ITEM_TYPE, "number_of_distinct_instance_items"], "target", "linear", "aic", 0.05)
    return rounded(sel.log_frame(spark).select("step", "action", "variable", "aic", "criterion"), 4)
