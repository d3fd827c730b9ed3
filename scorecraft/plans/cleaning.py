"""K7-K9: the cleaning steps before the split, the per-split imputation after
it, and the audit table of both.

The audit counts of all pre-split steps come from ONE aggregate over the rows
with one flag column per step (instead of a ``count()`` job after each step);
the offending ids of the anti-join step are a distinct DataFrame joined back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from scorecraft.functions.flags import target_from_score
from scorecraft.operators.clean import UNASSIGNED
from scorecraft.operators.distribution import QUARTILES, WHISKER
from scorecraft.operators.encode import add_swoe
from scorecraft.operators.group_quantiles import group_quantiles, join_null_safe
from scorecraft.operators.impute import IqrImputer
from scorecraft.operators.joins import broadcast_if_small, sized_join
from scorecraft.operators.split import hash_split, native_split
from scorecraft.session import staged

ID = "assessment_item_response_id"
DURATIONS = ["student_duration_mins", "timeliness_duration_mins", "item_attempt_duration_mins"]
SPLIT_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# The audit descriptions of the cleaning steps (the operators that do them follow).
STEPS = [
    (1, "Remove [unassigned] in response_correctness", "drop_value_keep_null"),
    (2, "Remove student start or stop null dates", "keep_dates_present"),
    (3, "Remove attempt stop dates before start date", "remove_bad_ids"),
]
POST_STEPS = [
    (4, "Reduce number of levels in item_type_code_name", "add_swoe", None),
    (5, "Impute max durations outliers in student attempt times", "IqrImputer",
     "student_duration_mins"),
    (6, "Impute timeliness durations min and max outliers", "IqrImputer",
     "timeliness_duration_mins"),
    (7, "Impute max durations outliers in item attempt times", "IqrImputer",
     "item_attempt_duration_mins"),
]


def _step_flags(df: DataFrame) -> DataFrame:
    c = F.col
    keep1 = c("response_correctness").isNull() | (c("response_correctness") != UNASSIGNED)
    keep2 = c("student_start_datetime").isNotNull() | c("student_stop_datetime").isNotNull()
    flagged = df.withColumns({"__k1": keep1, "__k2": keep1 & keep2})
    bad = (flagged.where(c("__k2") & (c("item_attempt_end_datetime_utc") < c("item_attempt_start_datetime_utc"))
                         & c(ID).isNotNull())
           .select(ID).distinct().withColumn("__bad", F.lit(True)))
    j = sized_join(flagged, bad, ID, "left")
    return j.withColumn("__k3", c("__k2") & c("__bad").isNull()).drop("__bad")


def clean_before_split(df: DataFrame) -> DataFrame:
    """K9: C7 -> C2 -> J3 -> B5."""
    return _kept(_step_flags(df))


def _kept(flagged: DataFrame) -> DataFrame:
    return (flagged.where("__k3").drop("__k1", "__k2", "__k3")
            .withColumn("target", target_from_score("raw_score")))


def split_frames(df: DataFrame, keys=SPLIT_KEYS, native: bool = False, seed: int | None = None):
    """(train, valid).  Default: hash of the key (deterministic); ``native``
    reproduces ``randomSplit`` on a reliably checkpointed copy (the cleaned
    frame comes out of an anti-join shuffle)."""
    if native:
        return tuple(native_split(df, checkpoint=True) if seed is None
                     else native_split(df, seed=seed, checkpoint=True))
    s = hash_split(df, keys)
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "valid").drop("split")


def impute_split(df: DataFrame, fit_on: DataFrame | None = None, c: float = 24.0) -> DataFrame:
    """K7 for one split: SWOE of the item type (inner join), then IQR imputation
    of the three durations.  Parameters are fitted on ``fit_on`` (default: the
    split itself, the study's leakage-prevention choice, Q25)."""
    base = fit_on if fit_on is not None else df
    from scorecraft.operators.encode import swoe_table
    from scorecraft.session import persisted
    table = swoe_table(base, "item_type_code_name", "target", c)
    enc = add_swoe(df, "item_type_code_name", "target", c, table=table)
    fit_frame = add_swoe(base, "item_type_code_name", "target", c, table=table) if fit_on is not None else enc
    with persisted(fit_frame) as cached:
        imp = IqrImputer(list(DURATIONS)).fit(cached)
    return imp.transform(enc)


def impute_by_split(df: DataFrame, split_col: str = "split", c: float = 24.0, keep=()) -> DataFrame:
    """K7 for all splits at once: the split is part of every grouping key, so
    the SWOE counts of all splits are one grouped aggregation and the fences of
    all (split, duration) pairs one grouped quantile search, joined back as tables.
    Equivalent to fitting each split on itself (Q25), for any number of splits, of
    which NULL is one; rows with a NULL item type drop (inner join)."""
    cat = "item_type_code_name"
    # written once: the counts, the quantile passes and the result read it
    df = staged(df.select(*dict.fromkeys([split_col, cat, "target", *DURATIONS, *keep])), "cleaned")
    cnt = (df.groupBy(split_col, cat).agg(F.count_if(F.col("target") == 1).alias("n_event"),
                                          F.count_if(F.col("target") == 0).alias("n_nonevent"),
                                          F.count(F.col("target")).alias("n_target"),
                                          F.sum(F.col("target").cast("double")).alias("sum_target")))
    cnt = staged(cnt, "swoe")
    p1 = cnt.groupBy(split_col).agg(F.try_divide(F.sum("sum_target"), F.sum("n_target")).alias("__p1"))
    swoe = F.ln(F.try_divide(F.col("n_event") + F.lit(c) * F.col("__p1"), F.col("n_nonevent") + F.lit(c) * (1 - F.col("__p1"))))
    table = join_null_safe(cnt, p1, [split_col]).select(split_col, cat, swoe.alias(f"{cat}_swoe")).where(F.col(cat).isNotNull())
    fences = group_quantiles(df.where(F.col(cat).isNotNull()), [split_col], DURATIONS, QUARTILES, lambda v: v >= 0)
    fences = fences.select(split_col, *[x for d in DURATIONS for x in (
        (F.col(f"{d}_q2") + WHISKER * (F.col(f"{d}_q2") - F.col(f"{d}_q0"))).alias(f"__high_{d}"), F.col(f"{d}_q1").alias(f"__mid_{d}"))])
    enc = join_null_safe(join_null_safe(df, broadcast_if_small(table), [split_col, cat]), broadcast_if_small(fences), [split_col])
    over = {d: F.col(d) > F.col(f"__high_{d}") for d in DURATIONS}
    out = enc.withColumns({f"{d}_imputed": over[d] for d in DURATIONS}).withColumns(
        {d: F.when(F.col(f"{d}_imputed"), F.col(f"__mid_{d}")).otherwise(F.col(d)) for d in DURATIONS})
    return out.drop(*[f"__{x}_{d}" for d in DURATIONS for x in ("high", "mid")])


def _removed_counts() -> list:
    """Rows that each step removes, of the flagged rows."""
    return [F.count_if(~F.col("__k1")).alias("r1"), F.count_if(F.col("__k1") & ~F.col("__k2")).alias("r2"),
            F.count_if(F.col("__k2") & ~F.col("__k3")).alias("r3")]


def pre_split_audit(df: DataFrame) -> DataFrame:
    """K8 (pre-split part): rows removed by each step, one aggregate."""
    return _removed(_step_flags(df).agg(*_removed_counts()))


def _removed(one: DataFrame) -> DataFrame:
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("step"), F.lit(d).alias("description"), F.col(f"r{n}").cast("long").alias("removed"),
                 F.lit(0).cast("long").alias("imputed"), F.lit("all").alias("data"), F.lit(fn).alias("function"))
        for n, d, fn in STEPS])))


def post_split_audit(imputed: DataFrame, data: str) -> DataFrame:
    """K8 (post-split part): imputed counts per step for one split, one aggregate."""
    aggs = [F.count_if(F.col(col + "_imputed")).alias(f"i{n}") for n, _, _, col in POST_STEPS if col]
    one = imputed.agg(*aggs)
    items = []
    for n, d, fn, col in POST_STEPS:
        imp = F.col(f"i{n}").cast("long") if col else F.lit(0).cast("long")
        items.append(F.struct(F.lit(n).alias("step"), F.lit(d).alias("description"),
                              F.lit(0).cast("long").alias("removed"), imp.alias("imputed"),
                              F.lit(data).alias("data"), F.lit(fn).alias("function")))
    return one.select(F.inline(F.array(*items)))


def post_split_audit_all(imputed: DataFrame, split_col: str = "split") -> DataFrame:
    """K8 (post-split part) for every split in one grouped aggregate."""
    aggs = [F.count_if(F.col(col + "_imputed")).alias(f"i{n}") for n, _, _, col in POST_STEPS if col]
    per = imputed.groupBy(split_col).agg(*aggs)
    items = []
    for n, d, fn, col in POST_STEPS:
        imp = F.col(f"i{n}").cast("long") if col else F.lit(0).cast("long")
        items.append(F.struct(F.lit(n).alias("step"), F.lit(d).alias("description"),
                              F.lit(0).cast("long").alias("removed"), imp.alias("imputed"),
                              F.col(split_col).alias("data"), F.lit(fn).alias("function")))
    return per.select(F.inline(F.array(*items)))


def audit_table(df: DataFrame) -> DataFrame:
    """K8: the whole audit: pre-split removals, observed while the flagged rows are written,
    and per-split imputations from the written rows."""
    cols = dict.fromkeys([ID, *SPLIT_KEYS, "item_type_code_name", "raw_score", *DURATIONS, "response_correctness",
                          "student_start_datetime", "student_stop_datetime", "item_attempt_start_datetime_utc",
                          "item_attempt_end_datetime_utc"])
    seen = Observation("removed")  # counted while the rows are written
    flagged = staged(_step_flags(df.select(*cols)).observe(seen, *_removed_counts()), "audit")
    counts = df.sparkSession.createDataFrame([tuple(seen.get[f"r{n}"] for n, _, _ in STEPS)], "r1 long, r2 long, r3 long")
    return _removed(counts).unionByName(post_split_audit_all(impute_by_split(hash_split(_kept(flagged), SPLIT_KEYS))))
