"""Weight of evidence, smoothed WOE, information value, dummies.

Fitting is one scan and one shuffle for all encoded columns together
(``unpivot`` -> ``groupBy(variable, category)`` with map-side partial counts);
the encoding table has one row per category and is joined back with a
size-checked broadcast.  The reference's 2 + 1 + 2k jobs per column become one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.operators.joins import sized_join
from scorecraft.session import staged

# A zero event/non-event count is replaced by this before the log.
ZERO_CELL = 0.5


def category_counts(df: DataFrame, cols, label: str, good=1) -> DataFrame:
    """(variable, category, n_good, n_bad) for all columns in one pass.

    good = ``label == good``; bad = ``label != good``; NULL labels are in
    neither (Q18).  Categories are compared as strings."""
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("category"))
                            for c in cols])).alias("kv")
    lab = F.col(label)
    return (df.select(kv, lab.alias("__y")).select("kv.variable", "kv.category", "__y")
            .groupBy("variable", "category")
            .agg(F.count_if(F.col("__y") == F.lit(good)).alias("n_good"),
                 F.count_if(F.col("__y") != F.lit(good)).alias("n_bad")))


def woe_table(df: DataFrame, cols, label: str, good=1, smoothing: float = 0.0) -> DataFrame:
    """L1/L2: (variable, category, n_good, n_bad, good_dist, bad_dist, woe, iv).

    Zero cells count 0.5.  A NULL category is kept as a row whose counts are
    zero (hence 0.5), exactly as an equality test against NULL would count it;
    ``transform`` maps NULL to NULL.  ``smoothing > 0`` applies the class
    variant's literal formula ``ln((gd + rho*c)/bd + (1 - rho)*c)`` with rho
    the mean of the label (Q26)."""
    # the per-category counts are small (one row per category): written, so the
    # per-column totals are summed from them instead of re-scanning the rows
    cnt = staged(category_counts(df, cols, label, good), "categories")
    totals = F.broadcast(cnt.groupBy("variable").agg(F.sum("n_good").alias("t_good"),
                                                     F.sum("n_bad").alias("t_bad")))  # one row per column
    gd_n = F.when(F.col("category").isNull() | (F.col("n_good") == 0), F.lit(ZERO_CELL)).otherwise(F.col("n_good"))
    bd_n = F.when(F.col("category").isNull() | (F.col("n_bad") == 0), F.lit(ZERO_CELL)).otherwise(F.col("n_bad"))
    t = (cnt.join(totals, "variable")
         .withColumn("good_dist", F.try_divide(gd_n, F.col("t_good")))
         .withColumn("bad_dist", F.try_divide(bd_n, F.col("t_bad"))))
    ratio_log = F.ln(F.try_divide(F.col("good_dist"), F.col("bad_dist")))
    if smoothing and smoothing > 0:
        rho = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
        woe = F.ln(F.try_divide(F.col("good_dist") + F.lit(rho * smoothing), F.col("bad_dist"))
                   + F.lit((1 - rho) * smoothing))
    else:
        woe = ratio_log
    return t.select("variable", "category", "n_good", "n_bad", "good_dist", "bad_dist",
                    woe.alias("woe"), ((F.col("good_dist") - F.col("bad_dist")) * ratio_log).alias("iv"))


def information_value(table: DataFrame) -> DataFrame:
    """L4: IV per variable = sum over categories of (gd - bd) * ln(gd / bd)."""
    return table.groupBy("variable").agg(F.sum("iv").alias("iv"), F.count(F.lit(1)).alias("n_categories"))


def apply_woe(df: DataFrame, table: DataFrame, cols, suffix: str = "_woe") -> DataFrame:
    """Left-join each column's encoding; unseen or NULL category -> NULL."""
    out = df
    for c in cols:
        enc = table.where(F.col("variable") == c).select(
            F.col("category").alias(f"__cat_{c}"), F.col("woe").alias(c + suffix))
        out = sized_join(out.withColumn(f"__cat_{c}", F.col(c).cast("string")), enc, f"__cat_{c}", "left")
        out = out.drop(f"__cat_{c}")
    return out


def swoe_table(df: DataFrame, cat: str, target: str = "target", c: float = 24.0) -> DataFrame:
    """L3 fit: (cat, n_event, n_nonevent, <cat>_swoe) with
    swoe = ln((events + c*p1) / (non-events + c*(1 - p1))), p1 = mean target.

    p1 is derived from the per-category counts (which include the NULL category),
    so the whole fit is one grouped aggregation plus a sum over its result."""
    cnt = (df.groupBy(cat).agg(F.count_if(F.col(target) == 1).alias("n_event"),
                               F.count_if(F.col(target) == 0).alias("n_nonevent"),
                               F.count(F.col(target)).alias("n_target"),
                               F.sum(F.col(target).cast("double")).alias("sum_target")))
    cnt = staged(cnt, "swoe")
    tot = cnt.agg(F.sum("sum_target").alias("s"), F.sum("n_target").alias("n")).first()
    p1 = (tot["s"] / tot["n"]) if tot["n"] else None
    swoe = F.ln(F.try_divide(F.col("n_event") + F.lit(c * p1), F.col("n_nonevent") + F.lit(c * (1 - p1)))) \
        if p1 is not None else F.lit(None).cast("double")
    return cnt.select(cat, "n_event", "n_nonevent", swoe.alias(f"{cat}_swoe"))


def add_swoe(df: DataFrame, cat: str, target: str = "target", c: float = 24.0,
             how: str = "inner", table: DataFrame | None = None) -> DataFrame:
    """Join ``<cat>_swoe``; inner join drops NULL categories (Q12)."""
    t = swoe_table(df, cat, target, c) if table is None else table
    return sized_join(df, t.select(cat, f"{cat}_swoe"), cat, how)


def dummy_levels(df: DataFrame, col: str, max_levels: int | None = None) -> list[str]:
    """Distinct non-null levels, sorted; more than ``max_levels`` (if given) are an error."""
    lv = df.select(F.col(f"`{col}`").cast("string").alias("v")).where(F.col("v").isNotNull()).distinct()
    found = sorted(r["v"] for r in (lv if max_levels is None else lv.limit(max_levels + 1)).collect())
    if max_levels is not None and len(found) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels")
    return found


def dummy_columns(df: DataFrame, cols, mode: str = "dummy_dropfirst", max_levels: int | None = None) -> DataFrame:
    """0/1 columns ``<col>_<level>``.  ``dummy_dropfirst`` drops the
    alphabetically first level (``get_dummies(drop_first=True)``), ``dummy``
    keeps all levels, ``drop`` removes the string columns.  NULL -> all zeros.
    The result has a column per level; regressions and selections over strings do
    not go through it (``gram.Design``)."""
    out = df
    for c in cols:
        if mode == "drop":
            out = out.drop(c)
            continue
        levels = dummy_levels(df, c, max_levels)
        if mode != "dummy":
            levels = levels[1:]
        out = out.withColumns({f"{c}_{lv}": F.when(F.col(f"`{c}`").cast("string") == lv, 1).otherwise(0)
                               for lv in levels}).drop(c)
    return out


def dummy_vector(df: DataFrame, col: str, output_col: str | None = None) -> DataFrame:
    """L5 with Spark ML: levels indexed alphabetically descending and one-hot
    encoded with ``dropLast``, so the alphabetically first level is the zero
    vector (Q27).  Rows with a NULL level stay, as the zero vector too."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    out = output_col or col + "_vec"
    low = df.agg(F.min(F.col(col).cast("string"))).first()[0]
    df = df.withColumn(col + "__lvl", F.coalesce(F.col(col).cast("string"), F.lit(low if low is not None else "")))
    idx = StringIndexer(inputCol=col + "__lvl", outputCol=col + "__idx", stringOrderType="alphabetDesc").fit(df)
    ohe = OneHotEncoder(inputCol=col + "__idx", outputCol=out, dropLast=True).fit(idx.transform(df))
    return ohe.transform(idx.transform(df)).drop(col + "__idx", col + "__lvl")
