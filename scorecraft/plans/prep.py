"""Study preparation plans composed from the operators.

``prep_study`` is the flagship: scan -> C1 -> B3 -> C5 -> B5 -> K1 (IQR on the
item duration) -> L3 (SWOE of the item type) -> per-type summary.  The working
set is pruned to the five columns the plan needs and persisted once, because
the fit steps (quantile search, SWOE counts) read it several times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.functions.dates import add_durations
from scorecraft.functions.flags import target_from_score
from scorecraft.operators.clean import keep_ordered, keep_scored
from scorecraft.operators.encode import add_swoe, swoe_table
from scorecraft.operators.impute import IqrImputer
from scorecraft.session import persisted

DURATION = "item_attempt_duration_mins"
ITEM_TYPE = "item_type_code_name"
SWOE_C = 24.0


def study_frame(att: DataFrame) -> DataFrame:
    """C1 -> B3 -> C5 -> B5 on the attempts view."""
    d = keep_scored(att)
    d = keep_ordered(d, "item_attempt_start_datetime_utc", "item_attempt_end_datetime_utc")
    d = add_durations(d)
    return d.withColumn("target", target_from_score("raw_score"))


def prep_study(att: DataFrame, c: float = SWOE_C, approx: bool = False) -> DataFrame:
    work = study_frame(att).select(ITEM_TYPE, "target", DURATION)
    with persisted(work) as cached:  # the fit steps read it several times
        imputer = IqrImputer([DURATION], approx=approx).fit(cached)
        table = swoe_table(cached, ITEM_TYPE, "target", c)
    enc = add_swoe(imputer.transform(work), ITEM_TYPE, "target", c, table=table)
    return enc.groupBy(ITEM_TYPE).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg("target").alias("event_rate"),
        F.max(f"{ITEM_TYPE}_swoe").alias("swoe"),
        F.count_if(F.col(f"{DURATION}_imputed")).alias("n_imputed"),
        F.avg(DURATION).alias("mean_duration"))


# The study's fitted scoring formula (log-odds coefficients).
G3_INTERCEPT = -0.199966
G3_COEFS = {"student_duration_mins": 0.000709, "timeliness_duration_mins": 0.000003,
            "item_type_code_name_swoe": 0.979045, "number_of_distinct_instance_items": 0.008417}
MODEL_FEATURES = ["student_duration_mins", "timeliness_duration_mins", "item_type_code_name_swoe",
                  "number_of_distinct_instance_items"]


def scored_frame(att: DataFrame) -> DataFrame:
    """Study rows with SWOE (inner join) and the fixed-formula score (G3):
    label, score, prediction.  Rows without the two student durations drop."""
    from scorecraft.operators.model import classify, score_by_coefficients
    s = study_frame(att)
    s = add_swoe(s, ITEM_TYPE, "target", SWOE_C)
    s = s.where(F.col("student_duration_mins").isNotNull() & F.col("timeliness_duration_mins").isNotNull())
    s = score_by_coefficients(s, G3_COEFS, G3_INTERCEPT)
    return classify(s.withColumnRenamed("target", "label"))


def model_frame(att: DataFrame, which: str = "train") -> DataFrame:
    """The modelling table: cleaned (C7, C2, J3, B5), hash split, then SWOE and
    IQR imputation fitted on the split itself (K7)."""
    from scorecraft.functions.dates import add_durations as durations
    from scorecraft.operators.clean import keep_scored as c1
    from scorecraft.plans import cleaning
    c = (cleaning.clean_before_split(durations(c1(att)))
         .select(*cleaning.SPLIT_KEYS, ITEM_TYPE, "target", "number_of_distinct_instance_items",
                 *cleaning.DURATIONS))
    train, valid = cleaning.split_frames(c)
    return cleaning.impute_split(train if which == "train" else valid)
