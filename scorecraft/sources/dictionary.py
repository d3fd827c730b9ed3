"""The data dictionary that drives column groups.

The dictionary is metadata (one row per field), so it is a small DataFrame that
may be broadcast; its size is the number of columns of the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorecraft.functions.text import initials_label
from scorecraft.session import scratch_path

# Field, category and statistical type of every column of the
# item-attempt fact table, in the dictionary's own order.
DICTIONARY = [
    ("assessment_id", "Assessment", "Categorical Identifier"),
    ("assessment_instance_attempt_id", "Assignment Attempt", "Categorical Identifier"),
    ("assessment_instance_id", "Assessment", "Categorical Identifier"),
    ("assessment_item_response_id", "Item Attempt", "Categorical Identifier"),
    ("assigned_item_status", "Item Attempt", "Categorical Nominal"),
    ("assignment_attempt_number", "Assignment Attempt", "Numeric Continuous"),
    ("assignment_due_date", "Assignment", "Categorical Interval"),
    ("assignment_final_submission_date", "Assignment", "Categorical Interval"),
    ("assignment_late_submission", "Assignment", "Categorical Binary"),
    ("assignment_max_attempts", "Assignment", "Numeric Continuous"),
    ("assignment_start_date", "Assignment", "Categorical Interval"),
    ("ced_assignment_type_code", "Assignment", "Categorical Nominal"),
    ("final_score_unweighted", "Assignment Attempt", "Numeric Continuous"),
    ("is_affecting_grade", "Assignment", "Categorical Binary"),
    ("is_deleted", "Item Attempt", "Categorical Binary"),
    ("is_force_scored", "Assignment Attempt", "Categorical Binary"),
    ("is_manual_scoring_required", "Assignment Attempt", "Categorical Binary"),
    ("item_attempt_end_datetime_utc", "Item Attempt", "Categorical Interval"),
    ("item_attempt_start_datetime_utc", "Item Attempt", "Categorical Interval"),
    ("item_is_offline_scored", "Item", "Categorical Binary"),
    ("item_type_code_name", "Item", "Categorical Nominal"),
    ("learner_assigned_item_attempt_id", "Item Attempt", "Categorical Identifier"),
    ("learner_assignment_attempt_id", "Assignment Attempt", "Categorical Identifier"),
    ("learner_attempt_status", "Assignment Attempt", "Categorical Nominal"),
    ("learner_id", "Learner", "Categorical Identifier"),
    ("max_student_stop_datetime", "Assignment", "Categorical Interval"),
    ("min_student_start_datetime", "Assignment", "Categorical Interval"),
    ("number_of_distinct_instance_items", "Assignment", "Numeric Continuous"),
    ("number_of_learners", "Assignment", "Numeric Continuous"),
    ("org_id", "Organization", "Categorical Identifier"),
    ("points_possible_unweighted", "Assignment Attempt", "Numeric Continuous"),
    ("raw_score", "Item Attempt", "Numeric Continuous"),
    ("response_correctness", "Item Attempt", "Categorical Nominal"),
    ("scored_datetime", "Assignment Attempt", "Categorical Interval"),
    ("scoring_type_code", "Item", "Categorical Nominal"),
    ("section_id", "Section", "Categorical Identifier"),
    ("student_start_datetime", "Assignment Attempt", "Categorical Interval"),
    ("student_stop_datetime", "Assignment Attempt", "Categorical Interval"),
    ("was_fully_scored_datetime", "Assignment Attempt", "Categorical Interval"),
    ("was_in_progress_datetime", "Assignment Attempt", "Categorical Interval"),
    ("was_submitted_datetime_actual", "Assignment Attempt", "Categorical Interval"),
    ("item_attempt_duration_mins", "Item Attempt", "Numeric Continuous"),
    ("student_duration_mins", "Assignment Attempt", "Numeric Continuous"),
    ("timeliness_duration_mins", "Assignment Attempt", "Numeric Continuous"),
]

# The three derived duration columns.
DURATION_VARS = ["item_attempt_duration_mins", "student_duration_mins", "timeliness_duration_mins"]

TYPE_GROUPS = {
    "identifierVars": "Categorical Identifier",
    "nominalVars": "Categorical Nominal",
    "continuousVars": "Numeric Continuous",
    "intervalVars": "Categorical Interval",
    "binaryVars": "Categorical Binary",
}


DICTIONARY_SCHEMA = "field string, category string, type string, description string"


def dictionary_df(spark: SparkSession) -> DataFrame:
    """A2: the dictionary as a DataFrame (field, category, type)."""
    return spark.createDataFrame(DICTIONARY, "field string, category string, type string")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """A2: a dictionary CSV (field, category, type, description; with header)
    read with an explicit schema; the result is small and may be broadcast."""
    from scorecraft.sources.files import read_csv
    return read_csv(spark, path, DICTIONARY_SCHEMA).select("field", "category", "type", "description")


def written_dictionary(spark: SparkSession) -> DataFrame:
    """A2: the dictionary as a CSV file in the shared folder, read back by its schema."""
    path = scratch_path(spark, "dictionary")
    (dictionary_df(spark).withColumn("description", F.lit("")).coalesce(1).write.option("header", True).csv(path))
    return read_dictionary(spark, path)


def _restrict(d: DataFrame, columns) -> DataFrame:
    if not columns:
        return d
    present = d.sparkSession.createDataFrame([(c,) for c in columns], "field string")
    return d.join(F.broadcast(present), "field", "left_semi")


def var_categories(d: DataFrame, columns=None) -> DataFrame:
    """O1: sorted field list per entity category, restricted to present columns."""
    return (_restrict(d, columns).groupBy("category")
            .agg(F.sort_array(F.collect_list("field")).alias("fields"),
                 F.count(F.lit(1)).alias("n_fields")))


def var_types(d: DataFrame, columns=None) -> DataFrame:
    """O2: one row per field with its type and label ``field (ci)`` (joined, Q35)."""
    return (_restrict(d, columns)
            .select("type", "field", "category",
                    F.concat_ws(" ", F.col("field"), initials_label(F.col("category"))).alias("label")))


def variables_of_type(d: DataFrame, type_name: str) -> DataFrame:
    """O3: variables of one type with the category and its initials, ordered."""
    return (d.filter(F.col("type") == type_name)
            .select(F.concat_ws(" ", F.col("category"), initials_label(F.col("category"))).alias("category"),
                    F.col("field").alias("variable"),
                    F.concat_ws(" ", F.col("field"), initials_label(F.col("category"))).alias("variable_label"))
            .orderBy("category", "variable"))


def fields_of_type(type_name: str, columns=None) -> list[str]:
    """Driver-side helper: sorted field names of a type (bounded by the schema)."""
    out = sorted(f for f, _, t in DICTIONARY if t == type_name)
    if columns is not None:
        out = [f for f in out if f in set(columns)]
    return out


def label_map() -> dict[str, str]:
    """B11 helper: field -> ``field (ci)`` label."""
    def ini(cat: str) -> str:
        return "(" + "".join(w[0].lower() for w in cat.split()) + ")"
    return {f: f"{f} {ini(c)}" for f, c, _ in DICTIONARY}
