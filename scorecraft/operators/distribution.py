"""Fences, outlier reports, histograms, box-plot statistics.

All statistics for all requested columns come from one pass (or one pass plus
the bounded rounds of the exact quantile search); rows never leave Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.operators.quantiles import quantile_values

QUARTILES = (0.25, 0.5, 0.75)
WHISKER = 1.5


def fence_values(df: DataFrame, cols, non_negative: bool = True, approx: bool = False) -> dict:
    """{col: (low, high, median, q1, q3)} with Q1/Q3 over values >= 0 (Q22)."""
    flt = (lambda v: v >= 0) if non_negative else None
    q = quantile_values(df, cols, QUARTILES, flt, approx)
    out = {}
    for c in cols:
        q1, med, q3 = (q[(c, p)] for p in QUARTILES)
        if q1 is None:
            out[c] = (None, None, None, None, None)
            continue
        iqr = q3 - q1
        out[c] = (q1 - WHISKER * iqr, q3 + WHISKER * iqr, med, q1, q3)
    return out


def iqr_fences(df: DataFrame, cols, non_negative: bool = True, approx: bool = False) -> DataFrame:
    """D19 as a table: variable, q1, median, q3, iqr, low_fence, high_fence."""
    f = fence_values(df, cols, non_negative, approx)
    rows = [(c, v[3], v[2], v[4], None if v[3] is None else v[4] - v[3], v[0], v[1]) for c, v in f.items()]
    return df.sparkSession.createDataFrame(
        rows, "variable string, q1 double, median double, q3 double, iqr double, "
              "low_fence double, high_fence double")


def outlier_report(df: DataFrame, fences: dict) -> DataFrame:
    """Rows above each column's high fence and above any fence, with percent
    of all rows, in one aggregate pass."""
    conds = {c: F.col(c) > F.lit(v[1]) for c, v in fences.items() if v[1] is not None}
    any_c = None
    for cnd in conds.values():
        any_c = cnd if any_c is None else (any_c | cnd)
    aggs = [F.count(F.lit(1)).alias("__total")]
    aggs += [F.count_if(cnd).alias(c) for c, cnd in conds.items()]
    aggs.append(F.count_if(any_c if any_c is not None else F.lit(False)).alias("__any"))
    one = df.agg(*aggs)
    items = [F.struct(F.lit(c).alias("variable"), F.col(c).alias("outliers")) for c in conds]
    items.append(F.struct(F.lit("any").alias("variable"), F.col("__any").alias("outliers")))
    return one.select(F.col("__total").alias("total"), F.inline(F.array(*items))).select(
        "variable", F.col("outliers").cast("long").alias("outliers"), F.col("total").cast("long").alias("total"),
        F.round(F.try_divide(F.col("outliers") * 100.0, F.col("total")), 6).alias("pct"))


def flag_any_all(df: DataFrame, flags) -> DataFrame:
    """Rows with any / all of the boolean flags true, with percent."""
    any_c, all_c = None, None
    for f in flags:
        c = F.coalesce(F.col(f), F.lit(False))
        any_c = c if any_c is None else any_c | c
        all_c = c if all_c is None else all_c & c
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(any_c).alias("any_true"),
                  F.count_if(all_c).alias("all_true")).select(
        "total", "any_true", "all_true",
        F.round(F.try_divide(F.col("any_true") * 100.0, F.col("total")), 6).alias("any_pct"),
        F.round(F.try_divide(F.col("all_true") * 100.0, F.col("total")), 6).alias("all_pct"))


def histogram(df: DataFrame, col: str, bins: int = 10, log_counts: bool = False) -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed.

    One aggregate for min/max (two numbers to the driver), then one grouped
    count over bin indexes (partial aggregation; at most ``bins`` groups).
    Empty bins are emitted with count 0."""
    mm = df.agg(F.min(col).cast("double").alias("mn"), F.max(col).cast("double").alias("mx")).first()
    spark = df.sparkSession
    schema = "bin int, lower double, upper double, count long" + (", log10_count double" if log_counts else "")
    if mm["mn"] is None:
        return spark.createDataFrame([], schema)
    mn, mx = mm["mn"], mm["mx"]
    width = (mx - mn) / bins if mx > mn else 1.0
    idx = F.least(F.floor((F.col(col).cast("double") - F.lit(mn)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = df.where(F.col(col).isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = spark.createDataFrame([(i, mn + i * width, mn + (i + 1) * width) for i in range(bins)],
                                  "bin int, lower double, upper double")
    out = edges.join(F.broadcast(counts), "bin", "left").select(
        "bin", "lower", "upper", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))
    if log_counts:
        out = out.withColumn("log10_count", F.when(F.col("count") > 0, F.log10(F.col("count"))))
    return out


def month_ticks(df: DataFrame, cols) -> DataFrame:
    """(variable, tick): the first of every month from the month of a date column's
    minimum to its maximum; as many rows as the dates span months."""
    one = df.agg(*[f(F.col(c)).cast("date").alias(f"{c}__{n}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))])
    rows = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"{c}__lo").alias("lo"), F.col(f"{c}__hi").alias("hi")) for c in cols])))
    return rows.where("lo IS NOT NULL").select("variable", F.explode(F.sequence(F.trunc("lo", "MM"), F.col("hi"), F.expr("INTERVAL 1 MONTH"))).alias("tick"))


def boxplot_stats(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """Per (date or numeric) column: quartiles, whiskers at 1.5 IQR (the most
    extreme values inside the fences), outlier count, and min/max padded by one
    month for date axes.  Dates are handled as epoch seconds."""
    from scorecraft.functions.dates import epoch_seconds
    dtypes = dict(df.dtypes)
    is_date = {c: dtypes[c].startswith("timestamp") or dtypes[c] == "date" for c in cols}
    num = df.select(*[(epoch_seconds(c) if is_date[c] else F.col(c)).cast("double").alias(c) for c in cols])
    q = quantile_values(num, cols, QUARTILES, None, approx)
    aggs = []
    for c in cols:
        q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
        if q1 is None:
            lo, hi = None, None
        else:
            lo, hi = q1 - WHISKER * (q3 - q1), q3 + WHISKER * (q3 - q1)
        v = F.col(c)
        inside = v.between(F.lit(lo), F.lit(hi))
        aggs += [F.min(F.when(inside, v)).alias(f"{c}__wlo"), F.max(F.when(inside, v)).alias(f"{c}__whi"),
                 F.count_if((v < F.lit(lo)) | (v > F.lit(hi))).alias(f"{c}__out"),
                 F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max")]
    one = num.agg(*aggs)
    items = [F.struct(F.lit(c).alias("variable"), F.lit(q[(c, 0.25)]).alias("q1"),
                      F.lit(q[(c, 0.5)]).alias("median"), F.lit(q[(c, 0.75)]).alias("q3"),
                      F.col(f"{c}__wlo").alias("whisker_low"), F.col(f"{c}__whi").alias("whisker_high"),
                      F.col(f"{c}__out").cast("long").alias("outliers"),
                      F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"),
                      F.lit(is_date[c]).alias("is_date")) for c in cols]
    out = one.select(F.inline(F.array(*items)))
    ts = lambda x: F.timestamp_seconds(x.cast("long"))
    return out.select(
        "variable", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers", "min", "max",
        F.when(F.col("is_date"), F.add_months(ts(F.col("min")), -1)).alias("axis_min"),
        F.when(F.col("is_date"), F.add_months(ts(F.col("max")), 1)).alias("axis_max"))
