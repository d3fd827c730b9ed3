"""Catalogue: imputation, encoding, splits and the study-preparation flagship (K, L, S)."""

from __future__ import annotations

from scorecraft.plans import prep
from scorecraft.plans.catalog import att, query, rounded
from scorecraft.plans.oracle import STUDY_CTE, with_attempts

_PREP_SQL = with_attempts("""
SELECT i.item_type_code_name, count(*) AS n_rows, round(avg(i.target), 6) AS event_rate,
       round(max(e.swoe), 6) AS swoe, count_if(i.imputed) AS n_imputed, round(avg(i.dur), 6) AS mean_duration
FROM i JOIN e ON i.item_type_code_name = e.item_type_code_name
GROUP BY i.item_type_code_name""", STUDY_CTE, """q AS (
  SELECT quantile_cont(item_attempt_duration_mins, 0.25) AS q1,
         quantile_cont(item_attempt_duration_mins, 0.5) AS med,
         quantile_cont(item_attempt_duration_mins, 0.75) AS q3
  FROM study WHERE item_attempt_duration_mins >= 0)""", """i AS (
  SELECT s.item_type_code_name, s.target,
         CASE WHEN s.item_attempt_duration_mins > q.q3 + 1.5 * (q.q3 - q.q1) THEN q.med
              ELSE s.item_attempt_duration_mins END AS dur,
         s.item_attempt_duration_mins > q.q3 + 1.5 * (q.q3 - q.q1) AS imputed
  FROM study s, q)""", """p AS (SELECT avg(target) AS p1 FROM i)""", """e AS (
  SELECT item_type_code_name,
         ln((sum(target) + 24 * max(p1)) / (count(*) - sum(target) + 24 * (1 - max(p1)))) AS swoe
  FROM i, p GROUP BY item_type_code_name)""")


@query("prep_study", _PREP_SQL)
def q_prep_study(spark, sf):
    """Flagship: C1 -> B3 -> C5 -> B5 -> K1 -> L3, summarised per item type."""
    return rounded(prep.prep_study(att(spark, sf)))


# ---------------------------------------------------------------- shared SQL

from pyspark.sql import functions as F  # noqa: E402

from scorecraft.functions.dates import add_durations  # noqa: E402
from scorecraft.operators import clean, encode, impute, split  # noqa: E402
from scorecraft.plans import cleaning  # noqa: E402
from scorecraft.plans.catalog import tbl  # noqa: E402
from scorecraft.plans.prep import study_frame  # noqa: E402

_C1 = "assessment_item_response_id IS NOT NULL AND learner_attempt_status = 'fully scored'"
_DUR_SQL = """(epoch(item_attempt_end_datetime_utc) - epoch(item_attempt_start_datetime_utc)) / 60.0 AS item_attempt_duration_mins,
  (epoch(student_stop_datetime) - epoch(student_start_datetime)) / 60.0 AS student_duration_mins,
  (epoch(assignment_due_date) - epoch(student_start_datetime)) / 60.0 AS timeliness_duration_mins"""
_HASH75 = ("CASE WHEN CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 13) "
           "AS BIGINT) / 4503599627370496.0 < 0.75 THEN 'train' ELSE 'valid' END")
_CLEAN_CTES = [
    f"base AS (SELECT *, {_DUR_SQL} FROM attempts WHERE {_C1})",
    "c7 AS (SELECT * FROM base WHERE response_correctness IS NULL OR response_correctness <> '[unassigned]')",
    "c2 AS (SELECT * FROM c7 WHERE student_start_datetime IS NOT NULL OR student_stop_datetime IS NOT NULL)",
    """c3 AS (SELECT * FROM c2 WHERE assessment_item_response_id IS NULL OR assessment_item_response_id NOT IN (
      SELECT assessment_item_response_id FROM c2
      WHERE item_attempt_end_datetime_utc < item_attempt_start_datetime_utc AND assessment_item_response_id IS NOT NULL))""",
    f"cl AS (SELECT *, CASE WHEN raw_score > 0 THEN 1 ELSE 0 END AS target, {_HASH75} AS split FROM c3)",
]
_D3 = ["student_duration_mins", "timeliness_duration_mins", "item_attempt_duration_mins"]
_IMP_CTES = _CLEAN_CTES + [
    """sw AS (SELECT split, item_type_code_name, count_if(target = 1) AS e, count_if(target = 0) AS ne
           FROM cl GROUP BY 1, 2)""",
    "pp AS (SELECT split, avg(target) AS p1 FROM cl GROUP BY split)",
    """swt AS (SELECT sw.split, sw.item_type_code_name, ln((e + 24 * p1) / (ne + 24 * (1 - p1))) AS swoe
            FROM sw JOIN pp ON sw.split = pp.split)""",
    """j AS (SELECT cl.*, swt.swoe FROM cl JOIN swt
          ON cl.split = swt.split AND cl.item_type_code_name = swt.item_type_code_name)""",
    "fq AS (SELECT split, " + ", ".join(
        f"quantile_cont({c}, 0.25) FILTER (WHERE {c} >= 0) AS {c}_q1, "
        f"quantile_cont({c}, 0.5) FILTER (WHERE {c} >= 0) AS {c}_q2, "
        f"quantile_cont({c}, 0.75) FILTER (WHERE {c} >= 0) AS {c}_q3" for c in _D3) + " FROM j GROUP BY split)",
    "imp AS (SELECT j.split, j.swoe, " + ", ".join(
        f"j.{c} > fq.{c}_q3 + 1.5 * (fq.{c}_q3 - fq.{c}_q1) AS {c}_imputed, "
        f"CASE WHEN j.{c} > fq.{c}_q3 + 1.5 * (fq.{c}_q3 - fq.{c}_q1) THEN fq.{c}_q2 ELSE j.{c} END AS {c}"
        for c in _D3) + " FROM j JOIN fq ON j.split = fq.split)",
]


def _filtered(spark, sf):
    """C1 + B3: the study's filtered frame before cleaning."""
    return add_durations(clean.keep_scored(att(spark, sf)))


# ------------------------------------------------------------- K: cleaning

@query("clean_steps", with_attempts("""
SELECT split, count(*) AS n_rows, CAST(sum(target) AS BIGINT) AS n_target FROM cl GROUP BY split""",
                                     *_CLEAN_CTES))
def q_clean_steps(spark, sf):
    """K9: C7 -> C2 -> J3 -> B5 -> hash split 75/25."""
    c = cleaning.clean_before_split(_filtered(spark, sf))
    s = split.hash_split(c, cleaning.SPLIT_KEYS)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("target").cast("long").alias("n_target"))


@query("post_split_impute", with_attempts("SELECT split, count(*) AS n_rows, " + ", ".join(
    f"count_if({c}_imputed) AS n_{c}, round(avg({c}), 6) AS mean_{c}" for c in _D3)
    + ", round(avg(swoe), 6) AS mean_swoe FROM imp GROUP BY split", *_IMP_CTES))
def q_post_split_impute(spark, sf):
    """K7: per split SWOE + IQR imputation, each fitted on its own split (Q25);
    all splits share the same grouped passes (the split is part of each key)."""
    c = split.hash_split(cleaning.clean_before_split(_filtered(spark, sf)), cleaning.SPLIT_KEYS)
    d = cleaning.impute_by_split(c)
    return rounded(d.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[a for col in _D3 for a in (F.count_if(F.col(col + "_imputed")).alias(f"n_{col}"),
                                      F.avg(col).alias(f"mean_{col}"))],
        F.avg("item_type_code_name_swoe").alias("mean_swoe")))


def _audit_sql():
    steps = ["base", "c7", "c2", "c3"]
    parts = [f"SELECT {n} AS step, '{text}' AS description, (SELECT count(*) FROM {a}) - (SELECT count(*) FROM {b}) AS removed, "
             f"0 AS imputed, 'all' AS data, '{fn}' AS function" for (n, text, fn), a, b in zip(cleaning.STEPS, steps, steps[1:])]
    parts += [f"SELECT {n}, '{text}', 0, " + (f"count_if({col}_imputed)" if col else "0") + f", split, '{fn}' FROM imp GROUP BY split"
              for n, text, fn, col in cleaning.POST_STEPS]
    return with_attempts("\nUNION ALL ".join(parts), *_IMP_CTES)


@query("audit_table", _audit_sql())
def q_audit_table(spark, sf):
    """K8: cleaning audit (removed / imputed per step and data set)."""
    return cleaning.audit_table(_filtered(spark, sf))


@query("row_loss", with_attempts(f"""
SELECT count(*) AS before, count_if(coalesce(response_correctness IS NULL OR response_correctness <> '[unassigned]', false)) AS kept,
       count_if(NOT coalesce(response_correctness IS NULL OR response_correctness <> '[unassigned]', false)) AS removed
FROM attempts WHERE {_C1}"""))
def q_row_loss(spark, sf):
    """Removal count of a cleaning step equals the slice it targets."""
    c = F.col("response_correctness")
    return clean.row_loss(clean.keep_scored(att(spark, sf)), c.isNull() | (c != clean.UNASSIGNED))


@query("iqr_impute", with_attempts(
    "SELECT " + ", ".join(f"count_if({c}_imputed) AS n_{c}, round(max({c}), 6) AS max_{c}, "
                          f"round(avg({c}), 6) AS mean_{c}" for c in _D3) + " FROM imp0",
    f"base AS (SELECT *, {_DUR_SQL} FROM attempts WHERE {_C1})",
    "fq AS (SELECT " + ", ".join(
        f"quantile_cont({c}, 0.25) FILTER (WHERE {c} >= 0) AS {c}_q1, "
        f"quantile_cont({c}, 0.5) FILTER (WHERE {c} >= 0) AS {c}_q2, "
        f"quantile_cont({c}, 0.75) FILTER (WHERE {c} >= 0) AS {c}_q3" for c in _D3) + " FROM base)",
    "imp0 AS (SELECT " + ", ".join(
        f"b.{c} > fq.{c}_q3 + 1.5 * (fq.{c}_q3 - fq.{c}_q1) AS {c}_imputed, "
        f"CASE WHEN b.{c} > fq.{c}_q3 + 1.5 * (fq.{c}_q3 - fq.{c}_q1) THEN fq.{c}_q2 ELSE b.{c} END AS {c}"
        for c in _D3) + " FROM base b, fq)"))
def q_iqr_impute(spark, sf):
    """K1: outliers above the upper fence replaced by the median, flagged."""
    d = impute.iqr_impute(_filtered(spark, sf), _D3)
    return rounded(d.agg(*[a for c in _D3 for a in (F.count_if(F.col(c + "_imputed")).alias(f"n_{c}"),
                                                     F.max(c).alias(f"max_{c}"), F.avg(c).alias(f"mean_{c}"))]))


_OFF_CTE = [f"base AS (SELECT * FROM attempts WHERE {_C1})",
            "o AS (SELECT avg(epoch(scored_datetime) - epoch(student_stop_datetime)) AS off FROM base)",
            """k2 AS (SELECT b.*, b.scored_datetime IS NULL AS scored_datetime_imputed,
                 CASE WHEN b.scored_datetime IS NULL THEN epoch(b.student_stop_datetime) + o.off
                      ELSE epoch(b.scored_datetime) END AS scored_fill FROM base b, o)"""]


@query("offset_impute", with_attempts("""
SELECT org_id, count_if(scored_datetime_imputed) AS n_imputed, count(scored_fill) AS n_present,
       round(avg(scored_fill) / 86400.0, 6) AS mean_day
FROM k2 GROUP BY org_id""", *_OFF_CTE))
def q_offset_impute(spark, sf):
    """K2: NULL scored date from the stop date plus the mean offset (correct sign)."""
    d = impute.offset_impute(clean.keep_scored(att(spark, sf)), "scored_datetime", "student_stop_datetime",
                             flag="scored_datetime_imputed")
    from scorecraft.functions.dates import epoch_micros
    return rounded(d.groupBy("org_id").agg(
        F.count_if("scored_datetime_imputed").alias("n_imputed"), F.count("scored_datetime").alias("n_present"),
        (F.avg(epoch_micros("scored_datetime")) / 86400e6).alias("mean_day")))


@query("offset_impute_faithful", with_attempts("""
SELECT org_id, count_if(assignment_due_date IS NULL) AS n_filled, count(scored_fill) AS n_present,
       round(avg(scored_fill) / 86400.0, 6) AS mean_day
FROM (SELECT b.*, CASE WHEN b.assignment_due_date IS NULL
                       THEN epoch(b.student_start_datetime) - o.off
                       ELSE epoch(b.assignment_due_date) END AS scored_fill
      FROM base b, (SELECT avg(epoch(assignment_due_date) - epoch(student_start_datetime)) AS off FROM base) o) t
GROUP BY org_id""", f"base AS (SELECT * FROM attempts WHERE {_C1})"))
def q_offset_impute_faithful(spark, sf):
    """K3 as in the study: gaps of one date filled from another date shifted by
    the mean offset with the study's sign, and written to a third column (Q23)."""
    d = impute.offset_impute(clean.keep_scored(att(spark, sf)), "assignment_due_date", "student_start_datetime",
                             faithful=True, write_to="scored_datetime")
    from scorecraft.functions.dates import epoch_micros
    return rounded(d.groupBy("org_id").agg(
        F.count_if(F.col("assignment_due_date").isNull()).alias("n_filled"),
        F.count("scored_datetime").alias("n_present"),
        (F.avg(epoch_micros("scored_datetime")) / 86400e6).alias("mean_day")))


@query("guarded_offset_impute", with_attempts("""
SELECT org_id, count_if(sub_imputed) AS n_null_before, count(sub_fill) AS n_present,
       round(avg(sub_fill) / 86400.0, 6) AS mean_day
FROM (SELECT k2.*, k2.was_submitted_datetime_actual IS NULL AS sub_imputed,
             CASE WHEN NOT k2.scored_datetime_imputed AND k2.was_submitted_datetime_actual IS NULL
                       AND k2.final_score_unweighted > 0
                  THEN k2.scored_fill + o4.off4 ELSE epoch(k2.was_submitted_datetime_actual) END AS sub_fill
      FROM k2, (SELECT avg(epoch(was_submitted_datetime_actual) - scored_fill) AS off4 FROM k2) o4) t
GROUP BY org_id""", *_OFF_CTE))
def q_guarded_offset_impute(spark, sf):
    """K4: NULL submitted date from the scored date, only where the scored date
    was not itself imputed and the score is positive; flag added."""
    d = impute.offset_impute(clean.keep_scored(att(spark, sf)), "scored_datetime", "student_stop_datetime",
                             flag="scored_datetime_imputed")
    guard = (~F.col("scored_datetime_imputed")) & (F.col("final_score_unweighted") > 0)
    d = impute.offset_impute(d, "was_submitted_datetime_actual", "scored_datetime", guard=guard,
                             flag="was_submitted_datetime_actual_imputed")
    from scorecraft.functions.dates import epoch_micros
    return rounded(d.groupBy("org_id").agg(
        F.count_if("was_submitted_datetime_actual_imputed").alias("n_null_before"),
        F.count("was_submitted_datetime_actual").alias("n_present"),
        (F.avg(epoch_micros("was_submitted_datetime_actual")) / 86400e6).alias("mean_day")))


@query("recount_impute", with_attempts("""
SELECT a.org_id, count(*) AS n_rows, CAST(sum(c.number_of_learners_calc) AS BIGINT) AS sum_calc
FROM attempts a LEFT JOIN (SELECT assessment_instance_id, number_of_learners,
                                  count(DISTINCT learner_id) AS number_of_learners_calc
                           FROM attempts GROUP BY 1, 2) c
  ON a.assessment_instance_id = c.assessment_instance_id
GROUP BY a.org_id"""))
def q_recount_impute(spark, sf):
    """K5 faithful: grouping by (instance, stored count) then joining on the
    instance alone fans rows out when an instance has two stored counts (Q11)."""
    r = impute.recount_impute(att(spark, sf), by_stored=True)
    return r.groupBy("org_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.sum("number_of_learners").cast("long").alias("sum_calc"))


@query("collapse_levels", with_attempts("""
SELECT CASE WHEN t.item_type_code_name IS NULL OR f.pct < 6 THEN 'Other' ELSE t.item_type_code_name END AS item_type_code_name,
       count(*) AS n_rows
FROM m t LEFT JOIN (
  SELECT item_type_code_name, count(*) * 100.0 / (SELECT count(item_type_code_name) FROM m) AS pct
  FROM m WHERE item_type_code_name IS NOT NULL GROUP BY 1) f ON t.item_type_code_name = f.item_type_code_name
GROUP BY 1""", "m AS (SELECT CASE item_type_code_name " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in impute.LEVEL_SYNONYMS.items())
                             + " ELSE item_type_code_name END AS item_type_code_name FROM attempts)"))
def q_collapse_levels(spark, sf):
    """K6: synonyms merged; levels under 6 % of the non-NULL total and NULL -> 'Other'."""
    return impute.collapse_levels(att(spark, sf)).groupBy("item_type_code_name").agg(
        F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------- L: encoding

def _woe_ctes(cols):
    cnt = " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS category, count_if(target = 1) AS n_good, "
        f"count_if(target <> 1) AS n_bad FROM study GROUP BY 2" for c in cols)
    return [STUDY_CTE, f"cnt AS ({cnt})",
            "tot AS (SELECT variable, sum(n_good) AS tg, sum(n_bad) AS tb FROM cnt GROUP BY variable)",
            """wd AS (SELECT c.variable, c.category, c.n_good, c.n_bad,
             (CASE WHEN c.category IS NULL OR c.n_good = 0 THEN 0.5 ELSE c.n_good END) / t.tg AS gd,
             (CASE WHEN c.category IS NULL OR c.n_bad = 0 THEN 0.5 ELSE c.n_bad END) / t.tb AS bd
      FROM cnt c JOIN tot t ON c.variable = t.variable)"""]


def _woe_sql(cols, smoothing=0.0):
    rho = "(SELECT avg(target) FROM study)"
    woe = ("ln(gd / bd)" if not smoothing else
           f"ln((gd + {rho} * {smoothing}) / bd + (1 - {rho}) * {smoothing})")
    return with_attempts(f"""
SELECT variable, category, n_good, n_bad, round(gd, 6) AS good_dist, round(bd, 6) AS bad_dist,
       round({woe}, 6) AS woe, round((gd - bd) * ln(gd / bd), 6) AS iv
FROM wd""", *_woe_ctes(cols))


_WOE_COLS = ["item_type_code_name", "response_correctness"]


@query("woe", _woe_sql(_WOE_COLS))
def q_woe(spark, sf):
    """WOE and IV terms for two columns from one grouped pass; zero cells -> 0.5."""
    return rounded(encode.woe_table(study_frame(att(spark, sf)), _WOE_COLS, "target", 1))


@query("woe_smoothed", _woe_sql(_WOE_COLS, 24.0))
def q_woe_smoothed(spark, sf):
    """L2: the class variant's smoothed WOE formula, literally (Q26)."""
    return rounded(encode.woe_table(study_frame(att(spark, sf)), _WOE_COLS, "target", 1, smoothing=24.0))


@query("information_value", with_attempts("""
SELECT variable, round(sum((gd - bd) * ln(gd / bd)), 6) AS iv, count(*) AS n_categories FROM wd GROUP BY variable""",
                                           *_woe_ctes(["item_type_code_name", "response_correctness"])))
def q_information_value(spark, sf):
    """L4: IV per column."""
    t = encode.woe_table(study_frame(att(spark, sf)), _WOE_COLS, "target", 1)
    return rounded(encode.information_value(t))


@query("swoe", with_attempts("""
SELECT item_type_code_name, count_if(target = 1) AS n_event, count_if(target = 0) AS n_nonevent,
       round(ln((count_if(target = 1) + 24 * (SELECT avg(target) FROM study))
          / (count_if(target = 0) + 24 * (1 - (SELECT avg(target) FROM study)))), 6) AS item_type_code_name_swoe
FROM study GROUP BY item_type_code_name""", STUDY_CTE))
def q_swoe(spark, sf):
    """L3: smoothed WOE table, c = 24."""
    return rounded(encode.swoe_table(study_frame(att(spark, sf)), "item_type_code_name", "target", 24.0))


@query("enc_join", with_attempts("""
SELECT s.org_id, count(*) AS n_rows, count(e.swoe) AS n_encoded, round(avg(e.swoe), 6) AS mean_swoe
FROM study s LEFT JOIN (
  SELECT item_type_code_name, ln((count_if(target = 1) + 24 * (SELECT avg(target) FROM study))
          / (count_if(target = 0) + 24 * (1 - (SELECT avg(target) FROM study)))) AS swoe
  FROM study GROUP BY 1) e ON s.item_type_code_name = e.item_type_code_name
GROUP BY s.org_id""", STUDY_CTE))
def q_enc_join(spark, sf):
    """Encoding table joined on the category (left join keeps NULL categories)."""
    e = encode.add_swoe(study_frame(att(spark, sf)), "item_type_code_name", "target", 24.0, how="left")
    return rounded(e.groupBy("org_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.count("item_type_code_name_swoe").alias("n_encoded"),
                                           F.avg("item_type_code_name_swoe").alias("mean_swoe")))


@query("lookup_join", with_attempts("""
SELECT s.response_correctness, count(*) AS n_rows, round(avg(w.woe), 6) AS mean_woe
FROM study s LEFT JOIN (
  SELECT category, ln(gd / bd) AS woe FROM (
    SELECT c.category, (CASE WHEN c.category IS NULL OR c.g = 0 THEN 0.5 ELSE c.g END) / t.tg AS gd,
           (CASE WHEN c.category IS NULL OR c.b = 0 THEN 0.5 ELSE c.b END) / t.tb AS bd
    FROM (SELECT response_correctness AS category, count_if(target = 1) AS g, count_if(target <> 1) AS b
          FROM study GROUP BY 1) c,
         (SELECT count_if(target = 1) AS tg, count_if(target <> 1) AS tb FROM study) t) x) w
  ON s.response_correctness = w.category
GROUP BY s.response_correctness""", STUDY_CTE))
def q_lookup_join(spark, sf):
    """Fitted WOE applied by a (size-checked broadcast) join instead of a CASE chain."""
    s = study_frame(att(spark, sf))
    t = encode.woe_table(s, ["response_correctness"], "target", 1)
    e = encode.apply_woe(s, t, ["response_correctness"])
    return rounded(e.groupBy("response_correctness").agg(F.count(F.lit(1)).alias("n_rows"),
                                                         F.avg("response_correctness_woe").alias("mean_woe")))


@query("dummies", with_attempts("""
SELECT 'item_type_code_name_' || item_type_code_name AS column_name, count(*) AS n_ones
FROM study WHERE item_type_code_name > (SELECT min(item_type_code_name) FROM study)
GROUP BY 1""", STUDY_CTE))
def q_dummies(spark, sf):
    """Dummy columns, alphabetically first level dropped; ones per column."""
    d = encode.dummy_columns(study_frame(att(spark, sf)).select("item_type_code_name"), ["item_type_code_name"])
    cols = d.columns
    one = d.agg(*[F.sum(c).cast("long").alias(f"s{i}") for i, c in enumerate(cols)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("n_ones"))
                                         for i, c in enumerate(cols)])))


# ---------------------------------------------------------------- S: splits

@query("hash_sample", """
SELECT count(*) AS n_rows, round(sum(o_totalprice), 6) AS sum_price FROM orders
WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0 < 0.1""")
def q_hash_sample(spark, sf):
    """S1 (deterministic 10 % by key hash)."""
    s = split.hash_sample(tbl(spark, sf, "orders"), ["o_orderkey"], 0.10)
    return rounded(s.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_totalprice").alias("sum_price")))


@query("hash_split", """
SELECT CASE WHEN CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber)), 1, 13) AS BIGINT) / 4503599627370496.0 < 0.75
            THEN 'train' ELSE 'valid' END AS split, count(*) AS n_rows, round(sum(l_quantity), 6) AS sum_qty
FROM lineitem GROUP BY 1""")
def q_hash_split(spark, sf):
    """S2 (deterministic 75/25 by key hash)."""
    s = split.hash_split(tbl(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return rounded(s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_qty")))


@query("stratified_split", with_attempts("""
SELECT target, CASE WHEN rn <= floor(0.75 * n) THEN 'train' ELSE 'valid' END AS split, count(*) AS n_rows
FROM (SELECT target, row_number() OVER (PARTITION BY target ORDER BY
               CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 13) AS BIGINT)) AS rn,
             count(*) OVER (PARTITION BY target) AS n
      FROM study) t
GROUP BY 1, 2""", STUDY_CTE))
def q_stratified_split(spark, sf):
    """S3: exact per-class 75/25 split by key hash (distributed cut-off search)."""
    s = split.stratified_split(study_frame(att(spark, sf)), "target", cleaning.SPLIT_KEYS)
    return s.groupBy("target", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query("native_sample", """
SELECT CAST(0 AS BIGINT) AS foreign_rows, CAST(0 AS BIGINT) AS repeated_rows, true AS share_fits FROM orders LIMIT 1""")
def q_native_sample(spark, sf):
    """S1 as in the study: Bernoulli 10 % with a fixed seed.  Which rows it takes is
    the engine's own; the result says whether they are a sample: rows not in the table,
    rows taken twice, and whether their number is within 6 standard errors."""
    orders = tbl(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    taken = split.native_sample(orders).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("times"))
    table = orders.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("there"))
    f, n, k = split.SAMPLE_FRACTION, F.sum("there"), F.coalesce(F.sum("times"), F.lit(0))
    return table.join(taken, "o_orderkey", "full").agg(
        F.count_if(F.col("there").isNull()).alias("foreign_rows"), F.count_if(F.col("times") > F.col("there")).alias("repeated_rows"),
        (F.abs(k - f * n) <= 6 * F.sqrt(f * (1 - f) * n)).alias("share_fits"))


@query("native_split", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2""")
def q_native_split(spark, sf):
    """S2 as in the study: randomSplit([0.75, 0.25], seed).  The union of both halves
    holds every row once, wherever the engine puts it."""
    train, valid = split.native_split(tbl(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))
    return train.unionByName(valid).groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n_rows"))
