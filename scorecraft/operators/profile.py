"""Profile aggregates in long form.

Every per-column statistic family is ONE aggregate over the data (no repeated
scans per statistic); the one-row result is turned into long form with
``inline`` over an array of structs, which is a projection, not a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorecraft.functions.dates import epoch_micros
from scorecraft.operators.quantiles import quantile_values
from scorecraft.session import staged


def _long(one_row: DataFrame, items) -> DataFrame:
    return one_row.select(F.inline(F.array(*items)))


# Types whose values are whole numbers, or points of time, which are whole seconds as a rule.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DateType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def _whole_parts(c: str, kind) -> tuple[Column, Column]:
    """(whole number, rest) of a value, which together are the value."""
    if isinstance(kind, _TIMES):
        micros = epoch_micros(c).cast("long")
        return F.floor(micros / F.lit(1_000_000)).cast("long"), F.pmod(micros, F.lit(1_000_000)).cast("int")
    whole = F.unix_date(c) if isinstance(kind, T.DateType) else F.col(f"`{c}`").cast("int") if isinstance(kind, T.BooleanType) else F.col(f"`{c}`")
    return whole.cast("long"), F.lit(0)


def count_distinct_whole(df: DataFrame, keys, value: Column, rest: Column, alias: str = "n_distinct") -> DataFrame:
    """Distinct whole numbers per group, exactly: 64 neighbouring values are the bits of one
    number, combined before the shuffle, so what is shuffled shrinks with the density of the
    values and is never more than the values themselves."""
    rows = df.select(*keys, value.alias("__v"), rest.alias("__rest"))
    words = rows.groupBy(*keys, F.shiftright("__v", 6).alias("__word"), "__rest").agg(F.bit_or(F.expr("shiftleft(1L, CAST(__v & 63 AS INT))")).alias("__bits"))
    return words.groupBy(*keys).agg(F.coalesce(F.sum(F.bit_count("__bits")), F.lit(0)).cast("long").alias(alias))


def distinct_members(df: DataFrame, keys, member: str, alias: str) -> DataFrame:
    """Distinct members per group (NULL is none): by bitmaps where they are whole numbers."""
    kind = df.schema[member].dataType
    if isinstance(kind, (*_WHOLE, *_TIMES)):
        return count_distinct_whole(df, keys, *_whole_parts(member, kind), alias)
    return df.groupBy(*keys).agg(F.countDistinct(member).alias(alias))


def _with_distinct(df: DataFrame, cols, stats: DataFrame, approx: bool, out_cols) -> DataFrame:
    """``stats`` (one row per variable) with n_distinct.  Exact counts of whole numbers, dates
    and times come from bitmaps, those of other types from narrow (variable, value) pairs;
    both are combined before the shuffle, and no row is expanded by all columns at once."""
    if approx:
        one = df.agg(*[F.approx_count_distinct(c).alias(f"u{i}") for i, c in enumerate(cols)])
        counts = _long(one, [F.struct(F.lit(c).alias("variable"), F.col(f"u{i}").alias("n_distinct")) for i, c in enumerate(cols)])
    else:
        kinds = {f.name: f.dataType for f in df.schema.fields}
        whole = [c for c in cols if isinstance(kinds[c], (*_WHOLE, *_TIMES))]
        found = []
        if whole:
            kv = [F.struct(F.lit(c).alias("variable"), *(x.alias(n) for x, n in zip(_whole_parts(c, kinds[c]), ("v", "rest")))) for c in whole]
            found.append(count_distinct_whole(df.select(F.inline(F.array(*kv))), ["variable"], F.col("v"), F.col("rest")))
        other = [c for c in cols if c not in whole]
        if other:
            text = lambda c: (F.col(c) + 0.0 if isinstance(kinds[c], (T.DoubleType, T.FloatType)) else F.col(c)).cast("string")  # noqa: E731  -0.0 is 0.0
            pairs = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), text(c).alias("value")) for c in other])))
            found.append(pairs.where("value IS NOT NULL").distinct().groupBy("variable").agg(F.count(F.lit(1)).alias("n_distinct")))
        counts = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    # one row per column
    joined = stats.join(F.broadcast(counts), "variable", "left")
    return joined.withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)).cast("long")).select(*out_cols)


def _share(small: DataFrame, count_col: str = "count", name: str = "pct") -> DataFrame:
    """Percent of the total of a small grouped table (total = sum over its rows)."""
    small = staged(small, "shares")
    tot = small.agg(F.sum(count_col)).first()[0] or 0
    return small.withColumn(name, F.try_divide(F.col(count_col) * 100.0, F.lit(tot).cast("double")))


def row_count(df: DataFrame) -> DataFrame:
    """D1."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def row_report(df: DataFrame, predicate: Column) -> DataFrame:
    """Total, kept, removed and percent kept/removed in one pass."""
    keep = F.coalesce(predicate, F.lit(False))
    one = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(keep).alias("kept"))
    return one.select("total", "kept", (F.col("total") - F.col("kept")).alias("removed"),
                      F.try_divide(F.col("kept") * 100.0, F.col("total")).alias("pct_kept"),
                      F.try_divide((F.col("total") - F.col("kept")) * 100.0, F.col("total")).alias("pct_removed"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count per value (NULL is its own group), descending with a tie-break."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first(col)))


def distinct_per_group(df: DataFrame, group: str, member: str, alias: str) -> DataFrame:
    """Distinct members per group plus a 'mean' row = round(avg) (Q14)."""
    per = staged(distinct_members(df, [group], member, alias).withColumn(alias, F.col(alias).cast("double")), "per_group")
    mean = per.agg(F.round(F.avg(alias)).alias(alias)).select(F.lit("mean").alias(group), alias)
    return per.select(F.col(group).cast("string").alias(group), alias).unionByName(mean)


def mean_distinct_two_level(df: DataFrame, g1: str, g2: str, member: str, alias: str) -> DataFrame:
    """Distinct members per (g1, g2), averaged per g1 (unweighted), plus 'mean' row."""
    inner = distinct_members(df, [g1, g2], member, alias)
    per = staged(inner.groupBy(g1).agg(F.avg(alias).alias(alias)), "per_group")
    mean = per.agg(F.round(F.avg(alias)).alias(alias)).select(F.lit("mean").alias(g1), alias)
    return per.select(F.col(g1).cast("string").alias(g1), alias).unionByName(mean)


def mean_by_group(df: DataFrame, group: str, value: str, alias: str = "scores") -> DataFrame:
    """Mean per group plus the rounded unweighted mean of the group means."""
    per = staged(df.groupBy(group).agg(F.avg(value).alias(alias)), "per_group")
    mean = per.agg(F.round(F.avg(alias)).alias(alias)).select(F.lit("mean").alias(group), alias)
    return per.select(F.col(group).cast("string").alias(group), alias).unionByName(mean)


def group_describe(df: DataFrame, group: str, col: str) -> DataFrame:
    """Rounded count/min/mean/max per group."""
    return df.groupBy(group).agg(F.count(col).alias("count"), F.round(F.min(col)).alias("min"),
                                 F.round(F.avg(col)).alias("mean"), F.round(F.max(col)).alias("max"))


def column_stats(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """Per column distinct, null, min and max (min/max as text)."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c)
        aggs += [F.count_if(v.isNull()).alias(f"n{i}"),
                 F.min(v).cast("string").alias(f"a{i}"), F.max(v).cast("string").alias(f"b{i}")]
    items = [F.struct(F.lit(c).alias("variable"), F.col(f"n{i}").cast("long").alias("n_null"),
                      F.col(f"a{i}").alias("min"), F.col(f"b{i}").alias("max")) for i, c in enumerate(cols)]
    return _with_distinct(df, cols, _long(df.agg(*aggs), items), approx, ["variable", "n_distinct", "n_null", "min", "max"])


def date_statistics(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """Per date column distinct, null, min date and max date."""
    cols = sorted(cols)
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c)
        aggs += [F.count_if(v.isNull()).alias(f"n{i}"),
                 F.min(v.cast("date")).alias(f"a{i}"), F.max(v.cast("date")).alias(f"b{i}")]
    items = [F.struct(F.lit(c).alias("variable"), F.col(f"n{i}").cast("long").alias("n_null"),
                      F.col(f"a{i}").alias("min_date"), F.col(f"b{i}").alias("max_date")) for i, c in enumerate(cols)]
    return _with_distinct(df, cols, _long(df.agg(*aggs), items), approx, ["variable", "n_distinct", "n_null", "min_date", "max_date"])


def date_range(df: DataFrame, cols) -> DataFrame:
    """D9 (overall): earliest and latest date over all the columns."""
    return df.agg(F.least(*[F.min(F.col(c).cast("date")) for c in cols]).alias("min_date"),
                  F.greatest(*[F.max(F.col(c).cast("date")) for c in cols]).alias("max_date"))


def null_zero_counts(df: DataFrame, cols) -> DataFrame:
    """NULL and zero counts per column."""
    cols = sorted(cols)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n{i}"), F.count_if(F.col(c) == 0).alias(f"z{i}")]
    items = [F.struct(F.lit(c).alias("variable"), F.col(f"n{i}").cast("long").alias("n_null"),
                      F.col(f"z{i}").cast("long").alias("n_zero")) for i, c in enumerate(cols)]
    return _long(df.agg(*aggs), items)


def unique_nulls(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """Distinct and NULL counts per column."""
    cols = sorted(cols)
    return _with_distinct(df, cols, null_counts(df, cols), approx, ["variable", "n_null", "n_distinct"])


def null_counts(df: DataFrame, cols) -> DataFrame:
    """NULL count per column."""
    items = [F.struct(F.lit(c).alias("variable"), F.col(f"n{i}").cast("long").alias("n_null"))
             for i, c in enumerate(cols)]
    return _long(df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]), items)


# Columns known to be constant after filtering, skipped by default (Q15).
KNOWN_CONSTANT = ["assignment_late_submission", "learner_attempt_status", "is_deleted"]


def constant_columns(df: DataFrame, skip=KNOWN_CONSTANT) -> DataFrame:
    """Columns holding a single value (NULL counted as the value 'null'),
    with that value.  A column has exactly one distinct text value iff the
    minimum and maximum of that text agree, so one pass of min/max answers it
    without the per-column distinct-count expansion."""
    cols = [c for c in df.columns if not skip or c not in set(skip)]
    aggs = []
    for i, c in enumerate(cols):
        txt = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null"))
        aggs += [F.min(txt).alias(f"a{i}"), F.max(txt).alias(f"b{i}")]
    items = [F.struct(F.lit(c).alias("variable"), F.col(f"a{i}").alias("value"),
                      (F.col(f"a{i}") == F.col(f"b{i}")).alias("single")) for i, c in enumerate(cols)]
    return _long(df.agg(*aggs), items).where(F.col("single")).select("variable", "value")


def describe_long(df: DataFrame, cols) -> DataFrame:
    """Count, mean, sample stddev, min, max per column, long form, typed double."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"c{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"),
                 F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}")]
    items = []
    for i, c in enumerate(cols):
        for stat, key in (("count", "c"), ("mean", "m"), ("stddev", "s"), ("min", "a"), ("max", "b")):
            items.append(F.struct(F.lit(c).alias("variable"), F.lit(stat).alias("statistic"),
                                  F.col(f"{key}{i}").cast("double").alias("value")))
    return _long(df.agg(*aggs), items)


def summary_long(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """Describe plus exact (default) or approximate 25/50/75 % quartiles."""
    q = quantile_values(df, cols, (0.25, 0.5, 0.75), None, approx)
    quart = df.sparkSession.createDataFrame(
        [(c, f"{int(p * 100)}%", q[(c, p)]) for c in cols for p in (0.25, 0.5, 0.75)],
        "variable string, statistic string, value double")
    return describe_long(df, cols).unionByName(quart)


def event_rate(df: DataFrame, target: str = "target") -> DataFrame:
    """Mean of the target."""
    return df.agg(F.avg(F.col(target).cast("double")).alias("event_rate"))


def class_balance(df: DataFrame, target: str = "target") -> DataFrame:
    """Count and percent per class."""
    return _share(df.groupBy(target).agg(F.count(F.lit(1)).alias("count")))


def top_k(df: DataFrame, order_cols, k: int) -> DataFrame:
    """Ordered first k rows; Spark plans TakeOrderedAndProject (per-partition
    top-k, then a k-row merge).  Callers pass a full tie-break key."""
    return df.orderBy(*order_cols).limit(k)


def distinct_rows(df: DataFrame) -> DataFrame:
    """X1."""
    return df.distinct()


def except_report(df: DataFrame) -> DataFrame:
    """Incomplete rows counted as a set (EXCEPT DISTINCT, i.e. ``subtract``
    of the complete rows) and as a bag (every incomplete row), Q20.

    Both counts come from one grouping of the incomplete rows instead of the
    EXCEPT's full-row anti join against the complete rows."""
    return _except_counts(df)


def subtract_incomplete(df: DataFrame) -> DataFrame:
    """X2 as written in the study: ``df.subtract(df.dropna())``."""
    return df.subtract(df.dropna())


def _any_null(df: DataFrame) -> Column:
    cond = F.lit(False)
    for c in df.columns:
        cond = cond | F.col(c).isNull()
    return cond


def _except_counts(df: DataFrame) -> DataFrame:
    anyn = _any_null(df)
    tagged = df.select(anyn.alias("__inc"), F.struct(*df.columns).alias("__row"))
    per_row = tagged.where("__inc").groupBy("__row").agg(F.count(F.lit(1)).alias("k"))
    return per_row.agg(F.count(F.lit(1)).alias("incomplete_distinct"),
                       F.coalesce(F.sum("k"), F.lit(0)).alias("incomplete_rows"))


def compare_frames(frames: dict, stat_builder) -> DataFrame:
    """The same statistic over several frames, tagged by ``series``.
    ``stat_builder(df)`` must return a DataFrame; results are unioned by name."""
    out = None
    for name, f in frames.items():
        s = stat_builder(f).select(F.lit(name).alias("series"), "*")
        out = s if out is None else out.unionByName(s)
    return out
