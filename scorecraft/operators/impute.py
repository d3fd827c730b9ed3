"""Imputation as fit (small parameters) / transform (projection).

Fitted parameters are a handful of numbers per column (fences, medians, mean
offsets) or a per-group aggregate joined back with a size-checked broadcast."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.functions.dates import epoch_seconds
from scorecraft.operators.distribution import fence_values
from scorecraft.operators.joins import sized_join
from scorecraft.operators.profile import distinct_members
from scorecraft.session import staged

# Level-collapsing rule for item types.
LEVEL_SYNONYMS = {"FillinBlankResponse": "fillInTheBlank", "MultipleChoiceResponse": "multipleChoice"}
OTHER_LEVEL = "Other"
MIN_LEVEL_PCT = 6.0


@dataclass
class IqrImputer:
    """K1: values above Q3 + 1.5 IQR (quartiles of values >= 0) become the median;
    ``<col>_imputed`` flags them (NULL value -> NULL flag, Q22)."""
    cols: list
    approx: bool = False
    params: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "IqrImputer":
        f = fence_values(df, self.cols, non_negative=True, approx=self.approx)
        self.params = {c: (v[1], v[2]) for c, v in f.items()}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        flags, vals = {}, {}
        for c, (high, med) in self.params.items():
            if high is None:
                continue
            over = F.col(c) > F.lit(high)
            flags[c + "_imputed"] = over
            vals[c] = F.when(over, F.lit(med)).otherwise(F.col(c))
        return df.withColumns(flags).withColumns(vals)


def iqr_impute(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    return IqrImputer(list(cols), approx).fit(df).transform(df)


def mean_offset_seconds(df: DataFrame, target: str, source: str, sample_fraction: float | None = None,
                        seed: int = 8764664, sample_keys=None) -> float | None:
    """Mean of (target - source) in seconds over rows where both are present.
    ``sample_fraction`` reproduces the 10 % sample fit (S1), by the hash of ``sample_keys``
    where given; default uses all rows."""
    base = df
    if sample_fraction:
        from scorecraft.operators.split import hash_sample
        base = hash_sample(df, sample_keys, sample_fraction) if sample_keys else df.sample(False, sample_fraction, seed)
    return base.agg(F.avg(epoch_seconds(target) - epoch_seconds(source))).first()[0]


def offset_impute(df: DataFrame, target: str, source: str, guard=None, flag: str | None = None,
                  faithful: bool = False, write_to: str | None = None,
                  sample_fraction: float | None = None, offset: float | None = None, sample_keys=None) -> DataFrame:
    """K2/K3/K4: fill NULL ``target`` from ``source`` shifted by the mean offset.

    Default: target := source + mean(target - source).  ``faithful=True`` keeps
    the study's sign (source - mean) (Q23).  ``guard`` restricts which NULLs are
    filled (K4); ``flag`` adds ``<flag>`` = target IS NULL before filling;
    ``write_to`` writes the result to another column (K3 wrote ``scored_datetime``)."""
    off = mean_offset_seconds(df, target, source, sample_fraction, sample_keys=sample_keys) if offset is None else offset
    if off is None:
        return df.withColumn(flag, F.col(target).isNull()) if flag else df
    shift = -off if faithful else off
    cond = F.col(target).isNull()
    if guard is not None:
        cond = cond & guard
    filled = F.timestamp_seconds(epoch_seconds(source) + F.lit(shift)).cast(df.schema[target].dataType)
    out = df.withColumn(flag, F.col(target).isNull()) if flag else df
    return out.withColumn(write_to or target, F.when(cond, filled).otherwise(F.col(target)))


def recount_per_group(df: DataFrame, group: str = "assessment_instance_id", member: str = "learner_id",
                      stored: str | None = "number_of_learners", by_stored: bool = False) -> DataFrame:
    """Distinct members per group next to the stored value.  ``by_stored``
    groups by (group, stored) as the study did (fans out on join, Q11)."""
    keys = [group, stored] if (by_stored and stored) else [group]
    return distinct_members(df, keys, member, f"{stored or member}_calc")


def recount_impute(df: DataFrame, group: str = "assessment_instance_id", member: str = "learner_id",
                   stored: str = "number_of_learners", by_stored: bool = False) -> DataFrame:
    """K5: replace the stored count by the recomputed distinct count (J1 + B12)."""
    calc = recount_per_group(df, group, member, stored, by_stored).select(group, f"{stored}_calc")
    return (sized_join(df, calc, group, "left").drop(stored)
            .withColumnRenamed(f"{stored}_calc", stored))


def level_frequencies(df: DataFrame, col: str) -> DataFrame:
    """Level, count, percent of the non-NULL total (Q24)."""
    cnt = staged(df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt_per_group")), "levels")
    tot = cnt.where(F.col(col).isNotNull()).agg(F.sum("cnt_per_group")).first()[0] or 0
    return cnt.withColumn("perc_of_count_total",
                          F.try_divide(F.col("cnt_per_group") * 100.0, F.lit(tot).cast("double")))


def collapse_levels(df: DataFrame, col: str = "item_type_code_name", synonyms: dict | None = None,
                    min_pct: float = MIN_LEVEL_PCT, other: str = OTHER_LEVEL) -> DataFrame:
    """K6: merge synonymous levels, then levels below ``min_pct`` % (strict) of the
    non-NULL total, and NULL, become ``other``."""
    syn = LEVEL_SYNONYMS if synonyms is None else synonyms
    merged = df
    if syn:
        m = F.create_map(*[F.lit(x) for kv in syn.items() for x in kv])
        merged = df.withColumn(col, F.coalesce(m[F.col(col)], F.col(col)))
    # a NULL level is ``other`` without a lookup, so it stays out of the join
    rare = level_frequencies(merged, col).where(F.col("perc_of_count_total") < min_pct).select(F.col(col), F.lit(True).alias("__rare"))
    return (sized_join(merged, rare, col, "left").select(*merged.columns, "__rare")
            .withColumn(col, F.when(F.col(col).isNull() | F.coalesce(F.col("__rare"), F.lit(False)),
                                    F.lit(other)).otherwise(F.col(col)))
            .drop("__rare"))
