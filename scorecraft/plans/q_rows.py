"""Catalogue: sources, projections, filters, joins, scalar functions and the
data dictionary (A, B, C, J, E, O, U)."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from scorecraft.functions import columns as cols_
from scorecraft.functions import dates, flags
from scorecraft.operators import clean, joins
from scorecraft.operators.impute import recount_impute
from scorecraft.plans.catalog import att, query, rounded, tbl, ts_sql
from scorecraft.plans.oracle import STUDY_CTE, with_attempts
from scorecraft.session import scratch_path
from scorecraft.sources import dictionary as dct
from scorecraft.sources import files

# ---------------------------------------------------------------- A: sources


@query("scan_csv_schema", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_scan_csv_schema(spark, sf):
    """Nation written as CSV to the shared folder, read back with an
    explicit schema (no inference pass)."""
    path = scratch_path(spark, "nation_csv")
    files.write_csv(tbl(spark, sf, "nation"), path)
    return files.read_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int")


# Orders as CSV lines; a key of 1, 2 or 3 within its thousand misses a field, has one too many,
# or a total that is no number.
@query("csv_rejects", """
SELECT k % 1000 AS damage, count(*) AS n, CAST(sum(k) AS BIGINT) AS keys, round(sum(t), 2) AS total, min(line) AS first_line FROM (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 1000 IN (1, 2, 3) THEN NULL ELSE o_totalprice END AS t,
         CASE o_orderkey % 1000 WHEN 1 THEN o_orderkey || ',' || o_custkey
              WHEN 2 THEN o_orderkey || ',' || o_custkey || ',17.5,' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ',surplus'
              WHEN 3 THEN o_orderkey || ',' || o_custkey || ',many,' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS line FROM orders) x
WHERE line IS NOT NULL GROUP BY 1
UNION ALL SELECT -1, count(*), CAST(sum(o_orderkey) AS BIGINT), round(sum(o_totalprice), 2), NULL FROM orders WHERE o_orderkey % 1000 NOT IN (1, 2, 3)""")
def q_csv_rejects(spark, sf):
    """A1: a CSV file with short, long and unparsable lines: its good rows and its rejected lines."""
    o = tbl(spark, sf, "orders")
    key, cust, day = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderdate").cast("date").cast("string")
    damage = F.col("o_orderkey") % 1000
    line = (F.when(damage == 1, F.concat_ws(",", key, cust)).when(damage == 2, F.concat_ws(",", key, cust, F.lit("17.5"), day, F.lit("surplus")))
            .when(damage == 3, F.concat_ws(",", key, cust, F.lit("many"), day)).otherwise(F.concat_ws(",", key, cust, F.col("o_totalprice").cast("string"), day)))
    path = scratch_path(spark, "orders_csv")
    o.select(line).write.text(path)
    good, bad = files.read_csv_with_rejects(spark, path, "k bigint, c bigint, t double, d date", header=False)
    k = F.split("line", ",")[0].cast("long")
    kept = good.agg(F.lit(-1).cast("long").alias("damage"), F.count(F.lit(1)).alias("n"), F.sum("k").alias("keys"), F.round(F.sum("t"), 2).alias("total"),
                    F.lit(None).cast("string").alias("first_line"))
    return bad.groupBy((k % 1000).alias("damage")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(k).alias("keys"), F.lit(None).cast("double").alias("total"), F.min("line").alias("first_line")).unionByName(kept)


@query("stage_parquet", "SELECT r_regionkey, r_name FROM region")
def q_stage_parquet(spark, sf):
    """A3/A4/A5: stage a scan as parquet (no forced single file) and continue
    from the staged copy."""
    return files.stage_parquet(spark, tbl(spark, sf, "region"), scratch_path(spark, "region_pq"))


_ORDERS_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                 ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@query("schema_report", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null, "
    f"count(*) - count({c}) AS nulls FROM orders" for i, (c, t) in enumerate(_ORDERS_TYPES)))
def q_schema_report(spark, sf):
    """Dtype and non-null count per column, one aggregate pass."""
    return files.schema_report(tbl(spark, sf, "orders")).withColumnRenamed("column", "column_name")


# ------------------------------------------------------- B: derived columns


_CAST_SQL = """
SELECT o_orderstatus, count(*) AS n_rows, count(parsed) AS n_parsed,
       strftime(min(parsed), '%Y-%m-%d %H:%M:%S') AS min_parsed,
       strftime(max(parsed), '%Y-%m-%d %H:%M:%S') AS max_parsed
FROM (SELECT o_orderstatus,
             TRY_CAST(CASE WHEN o_orderkey % 7 = 0 THEN 'not a date'
                           ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS parsed
      FROM orders) t
GROUP BY o_orderstatus"""


@query("cast_dates", _CAST_SQL)
def q_cast_dates(spark, sf):
    """Text dates cast in bulk; unparsable text becomes NULL (Q2)."""
    o = tbl(spark, sf, "orders")
    txt = o.select("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, F.lit("not a date"))
                   .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("parsed"))
    d = dates.cast_timestamps(txt, ["parsed"])
    return rounded(d.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("parsed").alias("n_parsed"),
        F.min("parsed").alias("min_parsed"), F.max("parsed").alias("max_parsed")))


def _months_between_sql(a: str, b: str) -> str:
    """Spark's months_between spelled out (whole months when same day-of-month
    or both month ends, else the day/second remainder over 31 days, 8 digits)."""
    return f"""round((year({a}) * 12 + month({a})) - (year({b}) * 12 + month({b}))
      + CASE WHEN day({a}) = day({b})
               OR (CAST({a} AS DATE) = last_day(CAST({a} AS DATE)) AND CAST({b} AS DATE) = last_day(CAST({b} AS DATE)))
             THEN 0
             ELSE ((day({a}) - day({b})) * 86400
                   + (epoch({a}) - epoch(date_trunc('day', {a})))
                   - (epoch({b}) - epoch(date_trunc('day', {b})))) / 2678400.0 END, 8)"""


AS_OF = "1998-06-01 00:00:00"

_SENTINEL_SQL = with_attempts(f"""
SELECT org_id, count(*) AS n_rows, count(was_submitted_datetime_actual) AS n_before,
       count(cleaned) AS n_after, {ts_sql('min(cleaned)')} AS min_after, {ts_sql('max(cleaned)')} AS max_after
FROM (SELECT org_id, was_submitted_datetime_actual,
             CASE WHEN abs({_months_between_sql('was_submitted_datetime_actual', "TIMESTAMP '" + AS_OF + "'")}) > 30
                  THEN NULL ELSE was_submitted_datetime_actual END AS cleaned
      FROM attempts) t
GROUP BY org_id""")


@query("null_sentinel_dates", _SENTINEL_SQL)
def q_null_sentinel_dates(spark, sf):
    """Dates more than 30 months from an explicit as-of date become NULL (Q3)."""
    a = att(spark, sf).select("org_id", "was_submitted_datetime_actual")
    a = a.withColumn("cleaned", dates.null_sentinel("was_submitted_datetime_actual", AS_OF))
    return rounded(a.groupBy("org_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("was_submitted_datetime_actual").alias("n_before"),
        F.count("cleaned").alias("n_after"), F.min("cleaned").alias("min_after"),
        F.max("cleaned").alias("max_after")))


_DUR_SQL = with_attempts("""
SELECT org_id, count(*) AS n_rows,
       round(sum(item_attempt_duration_mins), 6) AS sum_item, round(sum(student_duration_mins), 6) AS sum_student,
       round(sum(timeliness_duration_mins), 6) AS sum_timeliness,
       count(student_duration_mins) AS n_student, count(timeliness_duration_mins) AS n_timeliness
FROM study GROUP BY org_id""", STUDY_CTE)


@query("durations", _DUR_SQL)
def q_durations(spark, sf):
    """B3 (with C1, C5): attempt durations in minutes, NULL when a date is missing."""
    from scorecraft.plans.prep import study_frame
    s = study_frame(att(spark, sf))
    return rounded(s.groupBy("org_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("item_attempt_duration_mins").alias("sum_item"),
        F.sum("student_duration_mins").alias("sum_student"),
        F.sum("timeliness_duration_mins").alias("sum_timeliness"),
        F.count("student_duration_mins").alias("n_student"),
        F.count("timeliness_duration_mins").alias("n_timeliness")))


_DATE_STATS_SQL = with_attempts("""
SELECT count(*) AS n_rows, round(sum(d), 6) AS sum_days, round(min(h), 6) AS min_hours,
       round(max(m), 6) AS max_minutes
FROM (SELECT (epoch(scored_datetime) - epoch(was_submitted_datetime_actual)) / 86400.0 AS d,
             (epoch(scored_datetime) - epoch(was_submitted_datetime_actual)) / 3600.0 AS h,
             (epoch(scored_datetime) - epoch(was_submitted_datetime_actual)) / 60.0 AS m
      FROM attempts
      WHERE NOT scored_datetime IN (TIMESTAMP '2999-01-01 00:00:00', TIMESTAMP '1900-01-01 00:00:00')
        AND NOT was_submitted_datetime_actual IN (TIMESTAMP '2999-01-01 00:00:00', TIMESTAMP '1900-01-01 00:00:00')) t""")


@query("date_stats", _DATE_STATS_SQL)
def q_date_stats(spark, sf):
    """Date difference in days/hours/minutes after dropping default dates."""
    d = dates.date_stats(att(spark, sf), "scored_datetime", "was_submitted_datetime_actual")
    return rounded(d.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("days").alias("sum_days"),
                         F.min("hours").alias("min_hours"), F.max("minutes").alias("max_minutes")))


@query("target_flag", with_attempts("""
SELECT CASE WHEN raw_score > 0 THEN 1 ELSE 0 END AS target, count(*) AS count FROM attempts GROUP BY 1"""))
def q_target_flag(spark, sf):
    """target = raw_score > 0 (NULL -> 0, Q6)."""
    return att(spark, sf).groupBy(flags.target_from_score().alias("target")).agg(
        F.count(F.lit(1)).alias("count"))


@query("zero_flags", with_attempts("""
SELECT CASE WHEN final_score_unweighted = 0 THEN 'Yes' ELSE 'No' END AS zero_final,
       CASE WHEN raw_score IS NULL THEN 'Null' WHEN raw_score = 0 THEN 'Yes' ELSE 'No' END AS zero_raw,
       count(*) AS count
FROM attempts GROUP BY 1, 2"""))
def q_zero_flags(spark, sf):
    """Zero-score indicator columns."""
    return att(spark, sf).groupBy(flags.zero_flag_yes_no().alias("zero_final"),
                                  flags.zero_flag_null_yes_no().alias("zero_raw")).agg(
        F.count(F.lit(1)).alias("count"))


@query("select_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def q_select_columns(spark, sf):
    """Allow-list then deny-list selection."""
    return cols_.select_cols(tbl(spark, sf, "customer"), include=["c_custkey", "c_name", "c_mktsegment",
                                                                  "c_acctbal"],
                             exclude=["c_acctbal"])


def _nonnull_long_sql(colnames, source="attempts"):
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS non_null FROM {source}"
                              for c in colnames)


def _nonnull_long(df):
    items = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("non_null"))
             for i, c in enumerate(df.columns)]
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]).select(
        F.inline(F.array(*items)))


_ATT_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "assessment_item_response_id", "org_id",
             "section_id", "learner_id", "assessment_id", "assessment_instance_id", "learner_attempt_status",
             "item_type_code_name", "response_correctness", "raw_score", "final_score_unweighted",
             "number_of_distinct_instance_items", "number_of_learners", "item_attempt_start_datetime_utc",
             "item_attempt_end_datetime_utc", "student_start_datetime", "student_stop_datetime",
             "assignment_due_date", "scored_datetime", "was_submitted_datetime_actual", "skewed_minutes"]


@query("drop_id_columns", with_attempts(_nonnull_long_sql(sorted(c for c in _ATT_COLS if not c.endswith("_id")))))
def q_drop_id_columns(spark, sf):
    """Drop identifier columns by pattern, sort names; non-null count per kept column."""
    return _nonnull_long(cols_.drop_id_columns(att(spark, sf)))


_LABELS = dct.label_map()


@query("relabel", with_attempts(" UNION ALL ".join(
    f"SELECT '{_LABELS.get(c, c)}' AS column_name, count({c}) AS non_null FROM attempts" for c in _ATT_COLS)))
def q_relabel(spark, sf):
    """Columns renamed to dictionary labels 'field (ci)'."""
    return _nonnull_long(cols_.relabel(att(spark, sf), _LABELS))


# Names by rule: capital letters in order.
_LETTERS = list(string.ascii_uppercase)


@query("id_to_name", """
SELECT nation_letter, count(*) AS count FROM customer
JOIN (SELECT n, chr(64 + CAST(row_number() OVER (ORDER BY n) AS INTEGER)) AS nation_letter
      FROM (SELECT DISTINCT c_nationkey AS n FROM customer) d) m ON customer.c_nationkey = m.n
GROUP BY nation_letter""")
def q_id_to_name(spark, sf):
    """Ids mapped in sorted order to supplied names."""
    c = joins.id_to_name(tbl(spark, sf, "customer"), "c_nationkey", "nation_letter", _LETTERS)
    return c.groupBy("nation_letter").agg(F.count(F.lit(1)).alias("count"))


@query("unpivot_result", """
SELECT o_orderstatus, 'n_orders' AS variable, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1
UNION ALL SELECT o_orderstatus, 'mean_price', round(avg(o_totalprice), 6) FROM orders GROUP BY 1
UNION ALL SELECT o_orderstatus, 'max_price', round(max(o_totalprice), 6) FROM orders GROUP BY 1""")
def q_unpivot_result(spark, sf):
    """A per-group result transposed to long form with ``unpivot``."""
    g = tbl(spark, sf, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"), F.avg("o_totalprice").alias("mean_price"),
        F.max("o_totalprice").alias("max_price"))
    return rounded(cols_.to_long(g, ["o_orderstatus"], ["n_orders", "mean_price", "max_price"]))


# ------------------------------------------------------------- C: filters

def _count_by_org(df):
    return df.groupBy("org_id").agg(F.count(F.lit(1)).alias("n_rows"))


def _org_sql(where: str) -> str:
    return with_attempts(f"SELECT org_id, count(*) AS n_rows FROM attempts WHERE {where} GROUP BY org_id")


_C1 = "assessment_item_response_id IS NOT NULL AND learner_attempt_status = 'fully scored'"


@query("keep_scored", _org_sql(_C1))
def q_keep_scored(spark, sf):
    """C1."""
    return _count_by_org(clean.keep_scored(att(spark, sf)))


@query("keep_either_date", _org_sql("student_start_datetime IS NOT NULL OR student_stop_datetime IS NOT NULL"))
def q_keep_either_date(spark, sf):
    """Either date present (Q8)."""
    return _count_by_org(clean.keep_dates_present(att(spark, sf), ["student_start_datetime",
                                                                    "student_stop_datetime"], "any"))


@query("keep_all_dates", _org_sql("assignment_due_date IS NOT NULL AND student_start_datetime IS NOT NULL "
                                  "AND student_stop_datetime IS NOT NULL"))
def q_keep_all_dates(spark, sf):
    """All dates present."""
    return _count_by_org(clean.keep_dates_present(
        att(spark, sf), ["assignment_due_date", "student_start_datetime", "student_stop_datetime"], "all"))


@query("start_le_stop", _org_sql("item_attempt_start_datetime_utc <= item_attempt_end_datetime_utc"))
def q_start_le_stop(spark, sf):
    """C5."""
    return _count_by_org(clean.keep_ordered(att(spark, sf), "item_attempt_start_datetime_utc",
                                            "item_attempt_end_datetime_utc"))


@query("student_start_le_stop", with_attempts("""
SELECT count(*) AS before, count_if(coalesce(student_start_datetime <= student_stop_datetime, false)) AS kept,
       count_if(NOT coalesce(student_start_datetime <= student_stop_datetime, false)) AS removed
FROM attempts"""))
def q_student_start_le_stop(spark, sf):
    """The check is a count of what the filter would remove (Q9)."""
    return clean.row_loss(att(spark, sf), F.col("student_start_datetime") <= F.col("student_stop_datetime"))


@query("drop_unassigned", with_attempts("""
SELECT response_correctness, count(*) AS n_rows FROM attempts
WHERE response_correctness IS NULL OR response_correctness <> '[unassigned]' GROUP BY 1"""))
def q_drop_unassigned(spark, sf):
    """Drop '[unassigned]', keep NULL."""
    return clean.drop_value_keep_null(att(spark, sf), "response_correctness").groupBy(
        "response_correctness").agg(F.count(F.lit(1)).alias("n_rows"))


@query("drop_null", _org_sql("raw_score IS NOT NULL"))
def q_drop_null(spark, sf):
    """C8."""
    return _count_by_org(clean.drop_null(att(spark, sf), "raw_score"))


@query("filter_then_project", with_attempts("""
SELECT org_id, count(*) AS n_rows, round(sum(raw_score), 6) AS sum_score FROM attempts
WHERE response_correctness IS NULL OR response_correctness <> '[unassigned]' GROUP BY org_id"""))
def q_filter_then_project(spark, sf):
    """The filter column is not in the projection: filter first (Q10)."""
    a = att(spark, sf)
    p = clean.filter_then_project(a, F.col("response_correctness").isNull()
                                  | (F.col("response_correctness") != clean.UNASSIGNED), ["org_id", "raw_score"])
    return rounded(p.groupBy("org_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("raw_score").alias("sum_score")))


@query("slice_value", _org_sql("response_correctness = '[unassigned]'"))
def q_slice_value(spark, sf):
    """C10."""
    return _count_by_org(att(spark, sf).filter(F.col("response_correctness") == clean.UNASSIGNED))


@query("slice_null", _org_sql("student_start_datetime IS NULL AND student_stop_datetime IS NULL"))
def q_slice_null(spark, sf):
    """C11: NULL in A and NULL in B."""
    return _count_by_org(att(spark, sf).filter(F.col("student_start_datetime").isNull()
                                               & F.col("student_stop_datetime").isNull()))


@query("slice_threshold", _org_sql("skewed_minutes > 50000"))
def q_slice_threshold(spark, sf):
    """C12."""
    return _count_by_org(att(spark, sf).filter(F.col("skewed_minutes") > 50000))


@query("slice_conjunction", _org_sql("learner_attempt_status = 'fully scored' AND response_correctness = 'correct' "
                                     "AND number_of_learners = 1"))
def q_slice_conjunction(spark, sf):
    """Conjunction of three equalities."""
    c = F.col
    return _count_by_org(att(spark, sf).filter((c("learner_attempt_status") == clean.FULLY_SCORED)
                                               & (c("response_correctness") == "correct")
                                               & (c("number_of_learners") == 1)))


@query("before_cutoff", """
SELECT o_orderstatus, count(*) AS n_rows FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
GROUP BY o_orderstatus""")
def q_before_cutoff(spark, sf):
    """C14: literal cutoff, pushed into the parquet scan."""
    return clean.before_cutoff(tbl(spark, sf, "orders"), "o_orderdate", "1998-01-01 00:00:00").groupBy(
        "o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


@query("entity_lookup", with_attempts("""
SELECT DISTINCT org_id, section_id FROM attempts WHERE org_id = 1"""))
def q_entity_lookup(spark, sf):
    """One organisation's sections (filter, project, distinct, order)."""
    return clean.entity_lookup(att(spark, sf), "org_id", 1, ["org_id", "section_id"])


@query("complete_rows", with_attempts("""
SELECT org_id, count(*) AS n_rows FROM attempts
WHERE response_correctness IS NOT NULL AND raw_score IS NOT NULL AND item_type_code_name IS NOT NULL
GROUP BY org_id"""))
def q_complete_rows(spark, sf):
    """Rows without NULL."""
    a = att(spark, sf).select("org_id", "response_correctness", "raw_score", "item_type_code_name")
    return _count_by_org(clean.complete_rows(a))


# --------------------------------------------------------------- J: joins

@query("left_join_agg", with_attempts("""
SELECT a.org_id, count(*) AS n_rows, CAST(sum(c.number_of_learners_calc) AS BIGINT) AS sum_calc
FROM attempts a LEFT JOIN (SELECT assessment_instance_id, count(DISTINCT learner_id) AS number_of_learners_calc
                           FROM attempts GROUP BY assessment_instance_id) c
  ON a.assessment_instance_id = c.assessment_instance_id
GROUP BY a.org_id"""))
def q_left_join_agg(spark, sf):
    """Recomputed learners per instance joined back and replacing the stored value."""
    r = recount_impute(att(spark, sf))
    return r.groupBy("org_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.sum("number_of_learners").cast("long").alias("sum_calc"))


@query("anti_bad_ids", with_attempts("""
SELECT count(*) AS n_rows, count(assessment_item_response_id) AS n_with_id FROM attempts
WHERE assessment_item_response_id IS NULL OR assessment_item_response_id NOT IN (
  SELECT assessment_item_response_id FROM attempts
  WHERE item_attempt_end_datetime_utc < item_attempt_start_datetime_utc AND assessment_item_response_id IS NOT NULL)"""))
def q_anti_bad_ids(spark, sf):
    """Drop every row sharing an id with an end-before-start row (NULL ids kept, Q13)."""
    r = clean.remove_bad_ids(att(spark, sf), F.col("item_attempt_end_datetime_utc")
                             < F.col("item_attempt_start_datetime_utc"))
    return r.agg(F.count(F.lit(1)).alias("n_rows"), F.count("assessment_item_response_id").alias("n_with_id"))


# ---------------------------------------------------- E: scalar functions

@query("scalar_predicates", with_attempts("""
SELECT coalesce(response_correctness, 'none') AS rc,
       count_if(raw_score IS NOT NULL AND NOT (final_score_unweighted > 0)) AS a,
       count_if(item_type_code_name IN ('multipleChoice', 'orderList', 'drawing') OR raw_score IS NULL) AS b,
       CAST(sum(epoch(item_attempt_end_datetime_utc)) AS BIGINT) AS sum_epoch,
       count_if(round(final_score_unweighted) = 5) AS c
FROM attempts GROUP BY 1"""))
def q_scalar_predicates(spark, sf):
    """Null tests, boolean logic, IN lists, coalesce,
    epoch seconds and rounding inside one aggregate."""
    c = F.col
    a = att(spark, sf)
    return a.groupBy(F.coalesce(c("response_correctness"), F.lit("none")).alias("rc")).agg(
        F.count_if(c("raw_score").isNotNull() & ~(c("final_score_unweighted") > 0)).alias("a"),
        F.count_if(c("item_type_code_name").isin("multipleChoice", "orderList", "drawing") | c("raw_score").isNull()
                   ).alias("b"),
        F.sum(dates.epoch_seconds("item_attempt_end_datetime_utc")).cast("long").alias("sum_epoch"),
        F.count_if(F.round(c("final_score_unweighted")) == 5).alias("c"))


@query("scalar_aggregates", with_attempts("""
SELECT org_id, count(*) AS n, count(DISTINCT learner_id) AS n_learners, round(sum(raw_score), 6) AS s,
       round(avg(raw_score), 6) AS m, min(raw_score) AS lo, max(raw_score) AS hi
FROM attempts GROUP BY org_id"""))
def q_scalar_aggregates(spark, sf):
    """Count, countDistinct, sum, avg, min, max."""
    return rounded(att(spark, sf).groupBy("org_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("learner_id").alias("n_learners"),
        F.sum("raw_score").alias("s"), F.avg("raw_score").alias("m"), F.min("raw_score").alias("lo"),
        F.max("raw_score").alias("hi")))


# ----------------------------------------------- O/U: dictionary metadata

def _dict_values_sql():
    return "(VALUES " + ", ".join(f"('{f}', '{c}', '{t}')" for f, c, t in dct.DICTIONARY) + \
        ") AS d(field, category, type)"


def _initials_sql(c: str) -> str:
    return (f"'(' || array_to_string(list_transform(string_split_regex(trim({c}), '\\s+'), "
            f"lambda x: lower(substr(x, 1, 1))), '') || ')'")


_PRESENT = [c for c in _ATT_COLS if c in {f for f, _, _ in dct.DICTIONARY}]


@query("var_types", with_attempts(f"""
SELECT d.type, d.field, d.category, d.field || ' ' || {_initials_sql('d.category')} AS label, n.non_null
FROM {_dict_values_sql()}
JOIN ({_nonnull_long_sql(_PRESENT)}) n ON n.column_name = d.field"""))
def q_var_types(spark, sf):
    """Dictionary types and labels of the columns present,
    with each column's non-null count from the data."""
    a = att(spark, sf)
    t = dct.var_types(dct.written_dictionary(spark), a.columns)
    nn = _nonnull_long(a.select(*[c for c in a.columns if c in set(_PRESENT)]))
    return t.join(F.broadcast(nn), t["field"] == nn["column_name"]).select(
        "type", "field", "category", "label", "non_null")


@query("var_categories", with_attempts(f"""
SELECT d.category, count(*) AS n_fields, CAST(sum(n.non_null) AS BIGINT) AS non_null
FROM {_dict_values_sql()}
JOIN ({_nonnull_long_sql(_PRESENT)}) n ON n.column_name = d.field
GROUP BY d.category"""))
def q_var_categories(spark, sf):
    """O1: columns per entity category (present columns) with their non-null total."""
    a = att(spark, sf)
    cats = dct.var_categories(dct.written_dictionary(spark), a.columns)
    nn = _nonnull_long(a.select(*[c for c in a.columns if c in set(_PRESENT)]))
    per = cats.select("category", "n_fields", F.explode("fields").alias("field"))
    return (per.join(F.broadcast(nn), per["field"] == nn["column_name"])
            .groupBy("category").agg(F.max("n_fields").alias("n_fields"),
                                     F.sum("non_null").cast("long").alias("non_null")))


@query("initials_label", with_attempts(f"""
SELECT d.category || ' ' || {_initials_sql('d.category')} AS category, d.field AS variable,
       n.non_null
FROM {_dict_values_sql()}
JOIN ({_nonnull_long_sql(_PRESENT)}) n ON n.column_name = d.field
WHERE d.type = 'Categorical Interval'"""))
def q_initials_label(spark, sf):
    """Variables of one type listed with 'Category (ci)', for present columns."""
    a = att(spark, sf)
    v = dct.variables_of_type(dct.written_dictionary(spark), "Categorical Interval")
    nn = _nonnull_long(a.select(*[c for c in a.columns if c in set(_PRESENT)]))
    return v.join(F.broadcast(nn), v["variable"] == nn["column_name"]).select("category", "variable", "non_null")


@query("dictionary_types", with_attempts(f"""
SELECT d.type, count(*) AS n_fields, min(d.field) AS first_field, CAST(sum(n.non_null) AS BIGINT) AS non_null
FROM {_dict_values_sql()}
JOIN ({_nonnull_long_sql(_PRESENT)}) n ON n.column_name = d.field
GROUP BY d.type"""))
def q_dictionary_types(spark, sf):
    """Distinct statistical types of the present columns, dictionary ordered
    by field, with the non-null values each type holds in the data."""
    a = att(spark, sf)
    d = dct.written_dictionary(spark).orderBy("field")
    nn = _nonnull_long(a.select(*[c for c in a.columns if c in set(_PRESENT)]))
    return (d.join(F.broadcast(nn), d["field"] == nn["column_name"])
            .groupBy("type").agg(F.count(F.lit(1)).alias("n_fields"), F.min("field").alias("first_field"),
                                 F.sum("non_null").cast("long").alias("non_null")))

