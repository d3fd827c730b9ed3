"""Exact quantiles of every group, whatever their number and size.

The method is that of ``quantiles`` (a sketch brackets each wanted rank, only values
inside brackets are counted), but the brackets are a table of the groups, joined to
the rows, so groups are never part of a plan and nothing reaches the driver:

1. one aggregate per group: counts, extremes and sketch quantiles of all columns;
2. rows meet their group's brackets: one aggregate counts the rows under each bracket,
   another the frequencies of the values inside (combined before the shuffle);
3. a bracket holds about 4 / accuracy of a group's rows.  Where that is MAX_LEAF rows at
   most in every group, a window per bracket reads the ranks; else the frequencies are
   sorted over ranges of (group, bracket, value), and each range's totals give it its
   offset, so that a bracket of any size is read by as many tasks.

NULL is a group as any other key value.  NaN counts as NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorecraft.operators.joins import broadcast_if_small
from scorecraft.session import staged

# The sketch of a group is off by this share of its rows at most; brackets are twice as wide to each side.
GROUP_ACCURACY = 2_000
# Rows of a bracket that one task may read.
MAX_LEAF = 1_000_000


def join_null_safe(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Inner join of equal keys, NULL equal to NULL; the left side's keys stay."""
    renamed = right.withColumnsRenamed({k: f"__right{n}" for n, k in enumerate(keys)})
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"__right{n}")) for n, k in enumerate(keys)]
    return left.join(renamed, on).drop(*[f"__right{n}" for n in range(len(keys))])


def group_quantiles(df: DataFrame, keys, cols, probs, value_filter=None, accuracy: int = GROUP_ACCURACY) -> DataFrame:
    """One row per group: the keys and, for each column and probability, ``<column>_q<k>``
    (k counts the probabilities from 0), interpolated linearly; NULL for a group without values
    of that column."""
    keys, cols, probs = list(keys), list(cols), [float(p) for p in probs]
    slack = 2.0 / accuracy

    def value(c):
        v = F.col(f"`{c}`").cast("double")
        ok = v.isNotNull() & ~F.isnan(v)
        return F.when(ok & value_filter(v) if value_filter is not None else ok, v)
    rows = df.select(*[F.col(f"`{k}`") for k in keys], *[value(c).alias(f"__v{i}") for i, c in enumerate(cols)])
    fracs = [f for p in probs for f in (max(0.0, p - slack), min(1.0, p + slack))]
    groups = staged(rows.groupBy(*[f"`{k}`" for k in keys]).agg(*[a for i in range(len(cols)) for a in (
        F.count(f"__v{i}").alias(f"__n{i}"), F.min(f"__v{i}").alias(f"__a{i}"), F.max(f"__v{i}").alias(f"__z{i}"),
        F.percentile_approx(f"__v{i}", fracs, accuracy).alias(f"__s{i}"))]).withColumn("__g", F.monotonically_increasing_id()), "groups")

    # a wanted quantile: its number, column, probability and bracket
    wanted = [(i * len(probs) + j, i, j, p) for i in range(len(cols)) for j, p in enumerate(probs)]

    most = groups.agg(F.max(F.greatest(F.lit(0), *[F.col(f"__n{i}") for i in range(len(cols))]))).first()[0] or 0
    small = most * 6 / accuracy <= MAX_LEAF  # with what the sketch may be off at both ends

    def found(whole: bool, only: DataFrame | None) -> DataFrame:
        """(group, wanted, value at the lower rank, at the upper one) of all brackets that hold their
        ranks; ``whole`` takes the whole column for a bracket, ``only`` some groups."""
        def edge(i, j, p, low):
            if whole or (p <= slack if low else p >= 1 - slack):
                return F.col(f"__a{i}" if low else f"__z{i}")
            return F.col(f"__s{i}")[2 * j + (not low)]
        table = groups.select(*[f"`{k}`" for k in keys], "__g", *[c for q, i, j, p in wanted for c in (
            edge(i, j, p, True).alias(f"__lo{q}"), edge(i, j, p, False).alias(f"__hi{q}"))])
        if only is not None:
            table = table.join(only, "__g", "left_semi")
        met = join_null_safe(rows, broadcast_if_small(table, written=True), keys)
        below = met.groupBy("__g").agg(*[F.count_if(F.col(f"__v{i}") < F.col(f"__lo{q}")).alias(f"__b{q}") for q, i, _, _ in wanted])
        inside = F.filter(F.array(*[F.struct(F.lit(q).alias("q"), F.when(F.col(f"__v{i}").between(F.col(f"__lo{q}"), F.col(f"__hi{q}")), F.col(f"__v{i}")).alias("v"))
                                    for q, i, _, _ in wanted]), lambda x: x["v"].isNotNull())
        freq = met.select("__g", F.inline(inside)).groupBy("__g", "q", "v").agg(F.count(F.lit(1)).alias("n"))
        under = groups.join(below, "__g").select("__g", F.inline(F.array(*[
            F.struct(F.lit(q).alias("q"), F.floor((F.col(f"__n{i}") - 1) * F.lit(p)).alias("low"), F.ceil((F.col(f"__n{i}") - 1) * F.lit(p)).alias("high"),
                     F.col(f"__b{q}").alias("below")) for q, i, _, p in wanted])))
        at = lambda rank: F.max(F.when((F.col(rank) >= F.col("end") - F.col("n")) & (F.col(rank) < F.col("end")), F.col("v")))

        def ranks(read):
            return staged(read.groupBy("__g", "q").agg(at("low").alias("low"), at("high").alias("high")).where("low IS NOT NULL AND high IS NOT NULL"), "ranks")
        if small and not whole:
            up_to = Window.partitionBy("__g", "q").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
            return ranks(freq.withColumn("sum", F.sum("n").over(up_to)).join(under, ["__g", "q"]).withColumn("end", F.col("below") + F.col("sum")))
        freq = staged(freq.repartitionByRange("__g", "q", "v").withColumn("part", F.spark_partition_id()), "brackets")
        totals = freq.groupBy("__g", "q", "part").agg(F.sum("n").alias("t"))
        before = Window.partitionBy("__g", "q").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offset = totals.select("__g", "q", "part", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("offset"))
        within = Window.partitionBy("__g", "q", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        read = (freq.join(offset, ["__g", "q", "part"]).join(under, ["__g", "q"])
                .withColumn("end", F.col("below") + F.col("offset") + F.sum("n").over(within)))
        return ranks(read)

    got = found(False, None)
    # the sketch's promise leaves none; should one miss its rank, its group is read whole
    expected = groups.select("__g", F.inline(F.array(*[F.struct(F.lit(q).alias("q"), F.col(f"__n{i}").alias("n")) for q, i, _, _ in wanted]))).where("n > 0")
    missed = expected.join(got, ["__g", "q"], "left_anti").select("__g", "q")
    if not missed.isEmpty():
        missed = staged(missed, "missed")
        more = found(True, missed.select("__g").distinct()).join(missed, ["__g", "q"], "left_semi")
        got = staged(got.unionByName(more), "ranks")
    h = lambda i, p: (F.col(f"__n{i}") - 1) * F.lit(p)
    flat = got.groupBy("__g").agg(*[a for q, _, _, _ in wanted for a in (
        F.max(F.when(F.col("q") == q, F.col("low"))).alias(f"__l{q}"), F.max(F.when(F.col("q") == q, F.col("high"))).alias(f"__h{q}"))])
    return groups.join(flat, "__g", "left").select(*[f"`{k}`" for k in keys], *[
        (F.col(f"__l{q}") + (h(i, p) - F.floor(h(i, p))) * (F.col(f"__h{q}") - F.col(f"__l{q}"))).alias(f"{cols[i]}_q{j}") for q, i, j, p in wanted])
