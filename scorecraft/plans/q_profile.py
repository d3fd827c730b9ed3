"""Catalogue: profile aggregates, relations, distributions, top-k and set
operations (D, T, X)."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from scorecraft.functions import flags
from scorecraft.operators import clean, distribution, profile, relate
from scorecraft.operators.impute import level_frequencies, recount_per_group
from scorecraft.plans.catalog import att, query, rounded, tbl
from scorecraft.plans.oracle import STUDY_CTE, with_attempts
from scorecraft.plans.prep import study_frame

_C1 = "assessment_item_response_id IS NOT NULL AND learner_attempt_status = 'fully scored'"
DURS = ["item_attempt_duration_mins", "student_duration_mins", "timeliness_duration_mins", "skewed_minutes"]
DATE_COLS = ["item_attempt_start_datetime_utc", "item_attempt_end_datetime_utc", "student_start_datetime",
             "student_stop_datetime", "assignment_due_date", "scored_datetime", "was_submitted_datetime_actual"]
NUMERIC = ["raw_score", "final_score_unweighted", "number_of_distinct_instance_items", "number_of_learners"]
IDS = ["assessment_item_response_id", "org_id", "section_id", "learner_id", "assessment_id",
       "assessment_instance_id"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(parts):
    return "\nUNION ALL ".join(parts)


# ------------------------------------------------------------ D1-D7, X3

@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def q_row_count(spark, sf):
    """D1."""
    return profile.row_count(tbl(spark, sf, "lineitem"))


@query("row_report", with_attempts(f"""
SELECT count(*) AS total, count_if(coalesce({_C1}, false)) AS kept,
       count(*) - count_if(coalesce({_C1}, false)) AS removed,
       round(count_if(coalesce({_C1}, false)) * 100.0 / count(*), 6) AS pct_kept,
       round((count(*) - count_if(coalesce({_C1}, false))) * 100.0 / count(*), 6) AS pct_removed
FROM attempts"""))
def q_row_report(spark, sf):
    """Kept / removed / percent for the scored-rows filter, one pass."""
    pred = F.col("assessment_item_response_id").isNotNull() & (F.col("learner_attempt_status") == "fully scored")
    return rounded(profile.row_report(att(spark, sf), pred))


@query("value_counts", with_attempts(
    "SELECT item_type_code_name, count(*) AS count FROM attempts GROUP BY item_type_code_name"))
def q_value_counts(spark, sf):
    """Value counts (NULL kept as a group), descending."""
    return profile.value_counts(att(spark, sf), "item_type_code_name")


@query("distinct_per_group", with_attempts("""
SELECT CAST(org_id AS VARCHAR) AS org_id, CAST(count(DISTINCT section_id) AS DOUBLE) AS sections
FROM attempts GROUP BY org_id
UNION ALL
SELECT 'mean', round(avg(c)) FROM (SELECT count(DISTINCT section_id) AS c FROM attempts GROUP BY org_id) t"""))
def q_distinct_per_group(spark, sf):
    """Sections per organisation plus the rounded mean row."""
    return rounded(profile.distinct_per_group(att(spark, sf), "org_id", "section_id", "sections"))


@query("mean_distinct_two_level", with_attempts("""
SELECT CAST(org_id AS VARCHAR) AS org_id, round(avg(c), 6) AS learners
FROM (SELECT org_id, section_id, count(DISTINCT learner_id) AS c FROM attempts GROUP BY 1, 2) t GROUP BY org_id
UNION ALL
SELECT 'mean', round(avg(m)) FROM (
  SELECT avg(c) AS m FROM (SELECT org_id, section_id, count(DISTINCT learner_id) AS c FROM attempts GROUP BY 1, 2) t
  GROUP BY org_id) u"""))
def q_mean_distinct_two_level(spark, sf):
    """Learners per section averaged per organisation, plus mean row."""
    return rounded(profile.mean_distinct_two_level(att(spark, sf), "org_id", "section_id", "learner_id",
                                                   "learners"))


@query("mean_by_group", with_attempts("""
SELECT CAST(org_id AS VARCHAR) AS org_id, round(avg(final_score_unweighted), 6) AS scores FROM attempts GROUP BY org_id
UNION ALL
SELECT 'mean', round(avg(m)) FROM (SELECT avg(final_score_unweighted) AS m FROM attempts GROUP BY org_id) t"""))
def q_mean_by_group(spark, sf):
    """Mean score per organisation plus the mean of means."""
    return rounded(profile.mean_by_group(att(spark, sf), "org_id", "final_score_unweighted"))


@query("group_describe", with_attempts("""
SELECT org_id, count(raw_score) AS count, round(min(raw_score)) AS min, round(avg(raw_score)) AS mean,
       round(max(raw_score)) AS max
FROM attempts GROUP BY org_id"""))
def q_group_describe(spark, sf):
    """D7."""
    return rounded(profile.group_describe(att(spark, sf), "org_id", "raw_score"))


# ------------------------------------------------------------ D8-D15

_OCOLS = ["o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


@query("column_stats", _union(
    f"SELECT '{c}' AS variable, count(DISTINCT {c}) AS n_distinct, count_if({c} IS NULL) AS n_null, "
    f"CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max FROM orders" for c in _OCOLS))
def q_column_stats(spark, sf):
    """Distinct / null / min / max per column, one pass."""
    return profile.column_stats(tbl(spark, sf, "orders"), _OCOLS)


@query("date_statistics", with_attempts(_union(
    f"SELECT '{c}' AS variable, count(DISTINCT {c}) AS n_distinct, count_if({c} IS NULL) AS n_null, "
    f"CAST(min(CAST({c} AS DATE)) AS VARCHAR) AS min_date, CAST(max(CAST({c} AS DATE)) AS VARCHAR) AS max_date "
    f"FROM attempts" for c in sorted(DATE_COLS))))
def q_date_statistics(spark, sf):
    """Date statistics per column, one pass."""
    return rounded(profile.date_statistics(att(spark, sf), DATE_COLS))


@query("date_range", with_attempts(
    "SELECT CAST(least(" + ", ".join(f"min(CAST({c} AS DATE))" for c in DATE_COLS) + ") AS VARCHAR) AS min_date, "
    "CAST(greatest(" + ", ".join(f"max(CAST({c} AS DATE))" for c in DATE_COLS) + ") AS VARCHAR) AS max_date "
    "FROM attempts"))
def q_date_range(spark, sf):
    """D9 overall range over all date columns."""
    return rounded(profile.date_range(att(spark, sf), DATE_COLS))


@query("null_zero", with_attempts(_union(
    f"SELECT '{c}' AS variable, count_if({c} IS NULL) AS n_null, count_if({c} = 0) AS n_zero FROM attempts"
    for c in sorted(NUMERIC))))
def q_null_zero(spark, sf):
    """D10."""
    return profile.null_zero_counts(att(spark, sf), NUMERIC)


@query("unique_nulls", with_attempts(_union(
    f"SELECT '{c}' AS variable, count_if({c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct FROM attempts"
    for c in sorted(IDS))))
def q_unique_nulls(spark, sf):
    """D11."""
    return profile.unique_nulls(att(spark, sf), IDS)


@query("null_counts", with_attempts(_union(
    f"SELECT '{c}' AS variable, count_if({c} IS NULL) AS n_null FROM attempts" for c in DATE_COLS)))
def q_null_counts(spark, sf):
    """D12."""
    return profile.null_counts(att(spark, sf), DATE_COLS)


_CONST_COLS = ["org_id", "learner_attempt_status", "response_correctness", "number_of_learners", "assessment_id"]


@query("constant_columns", with_attempts(
    "SELECT variable, value FROM (" + _union(
        f"SELECT '{c}' AS variable, count(DISTINCT coalesce(CAST({c} AS VARCHAR), 'null')) AS n, "
        f"min(coalesce(CAST({c} AS VARCHAR), 'null')) AS value FROM attempts WHERE {_C1} AND response_correctness IS NULL"
        for c in _CONST_COLS) + ") t WHERE n = 1"))
def q_constant_columns(spark, sf):
    """Single-valued columns (NULL counted as 'null') with their value."""
    a = clean.keep_scored(att(spark, sf)).where(F.col("response_correctness").isNull()).select(*_CONST_COLS)
    return profile.constant_columns(a, skip=None)


def _describe_sql(cols, source):
    parts = []
    for c in cols:
        for stat, fn in (("count", f"CAST(count({c}) AS DOUBLE)"), ("mean", f"avg({c})"),
                         ("stddev", f"stddev_samp({c})"), ("min", f"min({c})"), ("max", f"max({c})")):
            parts.append(f"SELECT '{c}' AS variable, '{stat}' AS statistic, round(CAST({fn} AS DOUBLE), 6) AS value "
                         f"FROM {source}")
    return parts


@query("describe_long", _union(_describe_sql(LI_NUM, "lineitem")))
def q_describe_long(spark, sf):
    """Describe in long form."""
    return rounded(profile.describe_long(tbl(spark, sf, "lineitem"), LI_NUM))


@query("summary_quartiles", _union(_describe_sql(LI_NUM, "lineitem") + [
    f"SELECT '{c}', '{int(p * 100)}%', round(quantile_cont({c}, {p}), 6) FROM lineitem"
    for c in LI_NUM for p in (0.25, 0.5, 0.75)]))
def q_summary_quartiles(spark, sf):
    """Describe plus exact quartiles (distributed rank search)."""
    return rounded(profile.summary_long(tbl(spark, sf, "lineitem"), LI_NUM))


# ------------------------------------------------------------ D16-D18

@query("crosstab_cube", with_attempts("""
SELECT CASE WHEN grouping(a) = 1 THEN 'Total' ELSE a END AS response_correctness,
       CASE WHEN grouping(b) = 1 THEN 'Total' ELSE b END AS learner_attempt_status, count(*) AS count
FROM (SELECT coalesce(response_correctness, 'null') AS a, coalesce(learner_attempt_status, 'null') AS b
      FROM attempts) t
GROUP BY CUBE (a, b)"""))
def q_crosstab_cube(spark, sf):
    """Contingency table with margins via CUBE."""
    return relate.crosstab_margins(att(spark, sf), "response_correctness", "learner_attempt_status")


@query("crosstab_row_pct", with_attempts("""
SELECT zero_score, response_correctness, count,
       round_even(count * 100.0 / sum(count) OVER (PARTITION BY zero_score), 0) AS row_pct
FROM (SELECT CASE WHEN raw_score IS NULL THEN 'Null' WHEN raw_score = 0 THEN 'Yes' ELSE 'No' END AS zero_score,
             response_correctness, count(*) AS count
      FROM attempts WHERE response_correctness IS NOT NULL GROUP BY 1, 2) t"""))
def q_crosstab_row_pct(spark, sf):
    """Row percentages (half-to-even rounding, as the study's round)."""
    a = att(spark, sf).withColumn("zero_score", flags.zero_flag_null_yes_no("raw_score"))
    return rounded(relate.crosstab_row_pct(a, "zero_score", "response_correctness"))


@query("crosstab_col_share", """
SELECT l_returnflag, l_linestatus, count, round(count * 1.0 / sum(count) OVER (PARTITION BY l_linestatus), 6) AS col_share
FROM (SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY 1, 2) t""")
def q_crosstab_col_share(spark, sf):
    """Column-normalised table."""
    return rounded(relate.crosstab_col_share(tbl(spark, sf, "lineitem"), "l_returnflag", "l_linestatus"))


# ------------------------------------------------------------ D19-D22

def _fence_ctes():
    sel = ", ".join(
        f"quantile_cont({c}, 0.25) FILTER (WHERE {c} >= 0) AS {c}_q1, "
        f"quantile_cont({c}, 0.5) FILTER (WHERE {c} >= 0) AS {c}_q2, "
        f"quantile_cont({c}, 0.75) FILTER (WHERE {c} >= 0) AS {c}_q3" for c in DURS)
    return [STUDY_CTE, f"fq AS (SELECT {sel} FROM study)"]


@query("iqr_fences", with_attempts(_union(
    f"SELECT '{c}' AS variable, round({c}_q1, 6) AS q1, round({c}_q2, 6) AS median, round({c}_q3, 6) AS q3, "
    f"round({c}_q3 - {c}_q1, 6) AS iqr, round({c}_q1 - 1.5 * ({c}_q3 - {c}_q1), 6) AS low_fence, "
    f"round({c}_q3 + 1.5 * ({c}_q3 - {c}_q1), 6) AS high_fence FROM fq" for c in DURS), *_fence_ctes()))
def q_iqr_fences(spark, sf):
    """Quartiles, median and fences of values >= 0, all columns together."""
    return rounded(distribution.iqr_fences(study_frame(att(spark, sf)), DURS))


def _hf(c):
    return f"(fq.{c}_q3 + 1.5 * (fq.{c}_q3 - fq.{c}_q1))"


_ANY = " OR ".join(f"s.{c} > {_hf(c)}" for c in DURS)


@query("outlier_report", with_attempts(_union(
    [f"SELECT '{c}' AS variable, count_if(s.{c} > {_hf(c)}) AS outliers, count(*) AS total, "
     f"round(count_if(s.{c} > {_hf(c)}) * 100.0 / count(*), 6) AS pct FROM study s, fq" for c in DURS]
    + [f"SELECT 'any', count_if({_ANY}), count(*), round(count_if({_ANY}) * 100.0 / count(*), 6) FROM study s, fq"]),
    *_fence_ctes()))
def q_outlier_report(spark, sf):
    """Per-column and any-column outlier counts in one pass."""
    s = study_frame(att(spark, sf))
    return distribution.outlier_report(s, distribution.fence_values(s, DURS))


_IMP3 = DURS[:3]


@query("flag_any_all", with_attempts(f"""
SELECT count(*) AS total, count_if({' OR '.join(f"coalesce(s.{c} > {_hf(c)}, false)" for c in _IMP3)}) AS any_true,
       count_if({' AND '.join(f"coalesce(s.{c} > {_hf(c)}, false)" for c in _IMP3)}) AS all_true,
       round(count_if({' OR '.join(f"coalesce(s.{c} > {_hf(c)}, false)" for c in _IMP3)}) * 100.0 / count(*), 6) AS any_pct,
       round(count_if({' AND '.join(f"coalesce(s.{c} > {_hf(c)}, false)" for c in _IMP3)}) * 100.0 / count(*), 6) AS all_pct
FROM study s, fq""", *_fence_ctes()))
def q_flag_any_all(spark, sf):
    """Rows with any / all imputation flags set."""
    from scorecraft.operators.impute import IqrImputer
    s = study_frame(att(spark, sf))
    imp = IqrImputer(_IMP3).fit(s).transform(s)
    return distribution.flag_any_all(imp, [c + "_imputed" for c in _IMP3])


@query("freq_pct", with_attempts("""
SELECT item_type_code_name, count(*) AS cnt_per_group,
       round(count(*) * 100.0 / (SELECT count(item_type_code_name) FROM attempts), 6) AS perc_of_count_total
FROM attempts GROUP BY 1"""))
def q_freq_pct(spark, sf):
    """Level frequency with percent of the non-NULL total."""
    return rounded(level_frequencies(att(spark, sf), "item_type_code_name"))


# ------------------------------------------------------------ D23-D27

_DD = ["student_start_datetime", "student_stop_datetime", "scored_datetime", "assignment_due_date"]


@query("date_diff_matrix", with_attempts(_union(
    [f"SELECT '{c}' AS v1, '{c}' AS v2, 0.0 AS mean_diff" for c in _DD]
    + [f"SELECT '{a}', '{b}', round(avg(epoch_us({a}) - epoch_us({b})) / 3600000000.0, 6) FROM attempts"
       for a, b in itertools.permutations(_DD, 2)])))
def q_date_diff_matrix(spark, sf):
    """Mean hours between every pair of date columns."""
    return rounded(relate.date_diff_matrix(att(spark, sf), _DD, "h"))


@query("event_rate", with_attempts("SELECT round(avg(target), 6) AS event_rate FROM study", STUDY_CTE))
def q_event_rate(spark, sf):
    """D24."""
    return rounded(profile.event_rate(study_frame(att(spark, sf))))


@query("event_counts", with_attempts(_union(
    f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS category, count_if(target = 1) AS n_good, "
    f"count_if(target <> 1) AS n_bad FROM study GROUP BY 2" for c in ("item_type_code_name", "response_correctness")),
    STUDY_CTE))
def q_event_counts(spark, sf):
    """Event / non-event counts per category for several columns, one shuffle."""
    from scorecraft.operators.encode import category_counts
    return category_counts(study_frame(att(spark, sf)), ["item_type_code_name", "response_correctness"], "target")


@query("class_balance", with_attempts("""
SELECT target, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM study), 6) AS pct
FROM study GROUP BY target""", STUDY_CTE))
def q_class_balance(spark, sf):
    """D26."""
    return rounded(profile.class_balance(study_frame(att(spark, sf))))


@query("learners_recount", with_attempts("""
SELECT assessment_instance_id, number_of_learners, count(DISTINCT learner_id) AS number_of_learners_calc
FROM attempts GROUP BY 1, 2"""))
def q_learners_recount(spark, sf):
    """Distinct learners per (instance, stored count)."""
    return recount_per_group(att(spark, sf), by_stored=True)


# ------------------------------------------------------------ D28-D30

def _hist_sql(col, source, bins, log=False):
    extra = ", CASE WHEN coalesce(c.count, 0) > 0 THEN round(log10(c.count), 6) END AS log10_count" if log else ""
    return f"""
WITH mm AS (SELECT min({col}) AS mn, max({col}) AS mx FROM {source}),
w AS (SELECT mn, CASE WHEN mx > mn THEN (mx - mn) / {bins} ELSE 1.0 END AS wd FROM mm),
c AS (SELECT least(CAST(floor(({col} - w.mn) / w.wd) AS INTEGER), {bins - 1}) AS bin, count(*) AS count
      FROM {source}, w WHERE {col} IS NOT NULL GROUP BY 1)
SELECT CAST(r.range AS INTEGER) AS bin, round(w.mn + r.range * w.wd, 6) AS lower,
       round(w.mn + (r.range + 1) * w.wd, 6) AS upper, coalesce(c.count, 0) AS count{extra}
FROM range({bins}) r CROSS JOIN w LEFT JOIN c ON c.bin = r.range"""


@query("histogram", _hist_sql("l_extendedprice", "lineitem", 10))
def q_histogram(spark, sf):
    """10 equal-width bins."""
    return rounded(distribution.histogram(tbl(spark, sf, "lineitem"), "l_extendedprice", 10))


@query("log_histogram", _hist_sql("l_extendedprice", "lineitem", 100, log=True))
def q_log_histogram(spark, sf):
    """100 bins with log10 counts."""
    return rounded(distribution.histogram(tbl(spark, sf, "lineitem"), "l_extendedprice", 100, log_counts=True))


_BOX = ["item_attempt_start_datetime_utc", "item_attempt_end_datetime_utc", "student_start_datetime",
        "student_stop_datetime"]


def _box_sql():
    parts = []
    for c in _BOX:
        x = f"CAST(epoch({c}) AS DOUBLE)"
        lo = f"(bq.q1 - 1.5 * (bq.q3 - bq.q1))"
        hi = f"(bq.q3 + 1.5 * (bq.q3 - bq.q1))"
        parts.append(f"""SELECT '{c}' AS variable, round(bq.q1, 6) AS q1, round(bq.q2, 6) AS median, round(bq.q3, 6) AS q3,
  round(min({x}) FILTER (WHERE {x} BETWEEN {lo} AND {hi}), 6) AS whisker_low,
  round(max({x}) FILTER (WHERE {x} BETWEEN {lo} AND {hi}), 6) AS whisker_high,
  count_if({x} < {lo} OR {x} > {hi}) AS outliers, round(min({x}), 6) AS min, round(max({x}), 6) AS max,
  CAST(CAST(make_timestamp(CAST(min({x}) * 1000000 AS BIGINT)) - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS axis_min,
  CAST(CAST(make_timestamp(CAST(max({x}) * 1000000 AS BIGINT)) + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS axis_max
FROM attempts, (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.5) AS q2, quantile_cont({x}, 0.75) AS q3
                FROM attempts) bq
GROUP BY bq.q1, bq.q2, bq.q3""")
    return _union(parts)


@query("boxplot_stats", with_attempts(_box_sql()))
def q_boxplot_stats(spark, sf):
    """Box-plot statistics of date columns (epoch seconds) and padded axis range."""
    return rounded(distribution.boxplot_stats(att(spark, sf), _BOX))


# ------------------------------------------------------------ D31-D34

@query("corr_matrix", _union(
    [f"SELECT '{c}' AS v1, '{c}' AS v2, 1.0 AS value" for c in LI_NUM]
    + [f"SELECT '{a}', '{b}', round(corr({a}, {b}), 6) FROM lineitem" for a, b in itertools.permutations(LI_NUM, 2)]))
def q_corr_matrix(spark, sf):
    """Pairwise Pearson matrix, one pass."""
    return rounded(relate.corr_matrix(tbl(spark, sf, "lineitem"), LI_NUM))


_NOM = ["response_correctness", "learner_attempt_status", "item_type_code_name"]
_NUMS = ["raw_score", "final_score_unweighted"]


def _cramers_sql(a, b):
    return f"""SELECT '{a}' AS v1, '{b}' AS v2, chi2 / n AS phi2, n, r, k FROM (
  SELECT sum(cnt * cnt * n / (rt * ct)) - max(n) AS chi2, max(n) AS n,
         count(DISTINCT x) AS r, count(DISTINCT y) AS k
  FROM (SELECT x, y, cnt, sum(cnt) OVER (PARTITION BY x) AS rt, sum(cnt) OVER (PARTITION BY y) AS ct,
               CAST(sum(cnt) OVER () AS DOUBLE) AS n
        FROM (SELECT coalesce(CAST({a} AS VARCHAR), 'null') AS x, coalesce(CAST({b} AS VARCHAR), 'null') AS y,
                     count(*) AS cnt FROM attempts GROUP BY 1, 2) c) e) t"""


def _assoc_sql():
    cv = _union(_cramers_sql(a, b) for a, b in itertools.combinations(_NOM, 2))
    parts = [
        f"SELECT v1, v2, 'cramers_v' AS measure, round(sqrt(phi2 / (least(r, k) - 1)), 6) AS value FROM ({cv}) p",
        f"""SELECT v1, v2, 'cramers_v_corrected', round(sqrt(greatest(0.0, phi2 - (k - 1) * (r - 1) / (n - 1))
              / least((k - (k - 1) * (k - 1) / (n - 1)) - 1, (r - (r - 1) * (r - 1) / (n - 1)) - 1)), 6) FROM ({cv}) p""",
    ]
    for a, b in itertools.permutations(_NOM, 2):
        parts.append(f"""SELECT '{a}', '{b}', 'theils_u', CASE WHEN hx = 0 THEN 1.0 ELSE round(greatest(0.0, (hx - hxy) / hx), 6) END FROM (
  SELECT -sum(part) AS hx, max(hxy) AS hxy FROM (
    SELECT any_value(rt) / max(n) * ln(any_value(rt) / max(n)) AS part, max(hxy) AS hxy FROM (
      SELECT x, rt, n, sum(cnt / n * ln(ct / cnt)) OVER () AS hxy FROM (
        SELECT x, y, cnt, sum(cnt) OVER (PARTITION BY x) AS rt, sum(cnt) OVER (PARTITION BY y) AS ct, CAST(sum(cnt) OVER () AS DOUBLE) AS n
        FROM (SELECT coalesce(CAST({a} AS VARCHAR), 'null') AS x, coalesce(CAST({b} AS VARCHAR), 'null') AS y, count(*)::DOUBLE AS cnt
              FROM attempts GROUP BY 1, 2) c) e) f GROUP BY x) g) h""")
    for a in _NOM:
        for y in _NUMS:
            parts.append(f"""SELECT '{a}', '{y}', 'eta', round(sqrt(greatest(0.0,
  (sum(s * s / n) - sum(s) * sum(s) / sum(n)) / (sum(q) - sum(s) * sum(s) / sum(n)))), 6)
FROM (SELECT coalesce(CAST({a} AS VARCHAR), 'null') AS lvl, count({y}) AS n, sum({y}) AS s, sum({y} * {y}) AS q
      FROM attempts GROUP BY 1) g WHERE n > 0""")
    for a, b in itertools.combinations(_NUMS, 2):
        parts.append(f"SELECT '{a}', '{b}', 'pearson', round(corr({a}, {b}), 6) FROM attempts")
    return _union(parts)


@query("assoc_matrix", with_attempts(_assoc_sql()))
def q_assoc_matrix(spark, sf):
    """Cramér's V (plain, bias-corrected), Theil's U, correlation ratio and Pearson."""
    return rounded(relate.association_matrix(att(spark, sf), _NOM, _NUMS))


@query("density_2d", """
WITH mm AS (SELECT min(l_quantity) AS ax, max(l_quantity) AS bx, min(l_extendedprice) AS ay, max(l_extendedprice) AS byy
            FROM lineitem)
SELECT least(CAST(floor((l_quantity - ax) / ((bx - ax) / 20)) AS INTEGER), 19) AS bin_x,
       least(CAST(floor((l_extendedprice - ay) / ((byy - ay) / 20)) AS INTEGER), 19) AS bin_y, count(*) AS count
FROM lineitem, mm GROUP BY 1, 2""")
def q_density_2d(spark, sf):
    """2-D binned counts (scatter input)."""
    return relate.density_2d(tbl(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 20)


_DM = ["l_quantity", "l_extendedprice", "l_discount"]


def _density_matrix_sql():
    mm = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _DM)

    def b(c):
        return (f"least(CAST(floor(({c} - lo_{c}) / CASE WHEN hi_{c} > lo_{c} THEN (hi_{c} - lo_{c}) / 20 ELSE 1.0 END)"
                f" AS INTEGER), 19)")
    parts = [f"SELECT '{a}' AS v1, '{c}' AS v2, {b(a)} AS bin_x, {b(c)} AS bin_y, count(*) AS count "
             f"FROM lineitem, mm WHERE {a} IS NOT NULL AND {c} IS NOT NULL GROUP BY 3, 4"
             for a, c in itertools.combinations(_DM, 2)]
    return f"WITH mm AS (SELECT {mm} FROM lineitem)\n" + _union(parts)


@query("density_matrix", _density_matrix_sql())
def q_density_matrix(spark, sf):
    """D33 scatter matrix: binned counts for every column pair in one pass."""
    return relate.density_pairs(tbl(spark, sf, "lineitem"), _DM, 20)


@query("compare_frames", with_attempts(f"""
SELECT 'all' AS series, response_correctness, count(*) AS count FROM attempts GROUP BY 2
UNION ALL
SELECT 'scored', response_correctness, count(*) FROM attempts WHERE {_C1} GROUP BY 2"""))
def q_compare_frames(spark, sf):
    """One statistic over two frames, tagged and unioned."""
    a = att(spark, sf)
    return profile.compare_frames({"all": a, "scored": clean.keep_scored(a)},
                                  lambda d: profile.value_counts(d, "response_correctness"))


# ------------------------------------------------------------ T, X

@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def q_top_k(spark, sf):
    """Top 10 orders by price (the limit is the feature), full tie-break."""
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return profile.top_k(o, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


@query("ordered_list", "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def q_ordered_list(spark, sf):
    """Distinct pairs ordered by columns."""
    o = tbl(spark, sf, "orders").select("o_orderpriority", "o_orderstatus").distinct()
    return o.orderBy("o_orderpriority", "o_orderstatus")


@query("distinct_rows", with_attempts("SELECT DISTINCT org_id, section_id, assessment_id FROM attempts"))
def q_distinct_rows(spark, sf):
    """X1."""
    return profile.distinct_rows(att(spark, sf).select("org_id", "section_id", "assessment_id"))


@query("except_distinct", with_attempts("""
SELECT count(*) AS incomplete_distinct, CAST(coalesce(sum(k), 0) AS BIGINT) AS incomplete_rows FROM (
  SELECT org_id, response_correctness, item_type_code_name, count(*) AS k FROM attempts
  WHERE org_id IS NULL OR response_correctness IS NULL OR item_type_code_name IS NULL GROUP BY 1, 2, 3) t"""))
def q_except_distinct(spark, sf):
    """Incomplete rows as a set (subtract) and as a bag (Q20)."""
    a = att(spark, sf).select("org_id", "response_correctness", "item_type_code_name")
    return profile.except_report(a)


@query("subtract_incomplete", with_attempts("""
SELECT org_id, response_correctness, item_type_code_name FROM attempts
EXCEPT SELECT org_id, response_correctness, item_type_code_name FROM attempts
WHERE org_id IS NOT NULL AND response_correctness IS NOT NULL AND item_type_code_name IS NOT NULL"""))
def q_subtract_incomplete(spark, sf):
    """X2 as written: df.subtract(df.dropna())."""
    return profile.subtract_incomplete(att(spark, sf).select("org_id", "response_correctness",
                                                             "item_type_code_name"))



# ------------------------------------------------------ other supplied tables

@query("events_histogram", _hist_sql("value", "events", 50))
def q_events_histogram(spark, sf):
    """D28 on the event stream's values: 50 equal-width bins."""
    return rounded(distribution.histogram(tbl(spark, sf, "events"), "value", 50))


@query("events_boxplot", """
SELECT 'ts' AS variable, round(bq.q1, 6) AS q1, round(bq.q2, 6) AS median, round(bq.q3, 6) AS q3,
  round(min(x) FILTER (WHERE x BETWEEN bq.q1 - 1.5 * (bq.q3 - bq.q1) AND bq.q3 + 1.5 * (bq.q3 - bq.q1)), 6) AS whisker_low,
  round(max(x) FILTER (WHERE x BETWEEN bq.q1 - 1.5 * (bq.q3 - bq.q1) AND bq.q3 + 1.5 * (bq.q3 - bq.q1)), 6) AS whisker_high,
  count_if(x < bq.q1 - 1.5 * (bq.q3 - bq.q1) OR x > bq.q3 + 1.5 * (bq.q3 - bq.q1)) AS outliers,
  round(min(x), 6) AS min, round(max(x), 6) AS max,
  CAST(CAST(make_timestamp(CAST(min(x) * 1000000 AS BIGINT)) - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS axis_min,
  CAST(CAST(make_timestamp(CAST(max(x) * 1000000 AS BIGINT)) + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS axis_max
FROM (SELECT CAST(floor(epoch(ts)) AS DOUBLE) AS x FROM events) e,
     (SELECT quantile_cont(CAST(floor(epoch(ts)) AS DOUBLE), 0.25) AS q1,
             quantile_cont(CAST(floor(epoch(ts)) AS DOUBLE), 0.5) AS q2,
             quantile_cont(CAST(floor(epoch(ts)) AS DOUBLE), 0.75) AS q3 FROM events) bq
GROUP BY bq.q1, bq.q2, bq.q3""")
def q_events_boxplot(spark, sf):
    """D30/E9 on the event timestamps (whole epoch seconds)."""
    return rounded(distribution.boxplot_stats(tbl(spark, sf, "events"), ["ts"]))


@query("events_value_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def q_events_value_counts(spark, sf):
    """D3 on the event types."""
    return profile.value_counts(tbl(spark, sf, "events"), "event_type")
