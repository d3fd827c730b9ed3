"""Contingency tables, association and correlation
matrices, mean date differences and 2-D binned densities.

Each matrix is computed from one aggregation over the rows: pairwise Pearson
and mean differences are plain aggregate expressions; contingency counts for
all column pairs come from one ``explode`` of (pair, x, y) followed by a single
grouped count with map-side partial aggregation."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecraft.functions.dates import epoch_micros
from scorecraft.operators.joins import sized_join
from scorecraft.session import staged

NULL_LABEL = "null"
TOTAL_LABEL = "Total"


def _txt(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(NULL_LABEL))


def crosstab_margins(df: DataFrame, a: str, b: str) -> DataFrame:
    """Two-way counts with margins, NULL shown as 'null' (``crosstab(
    fillna('null'), margins=True)``) = CUBE(a, b); ``grouping`` tells the
    margin 'Total' apart from a real value (Q17).  Long form (a, b, count)."""
    x, y = _txt(a).alias(a), _txt(b).alias(b)
    return (df.select(x, y).cube(a, b)
            .agg(F.count(F.lit(1)).alias("count"), F.grouping(a).alias("__ga"), F.grouping(b).alias("__gb"))
            .select(F.when(F.col("__ga") == 1, F.lit(TOTAL_LABEL)).otherwise(F.col(a)).alias(a),
                    F.when(F.col("__gb") == 1, F.lit(TOTAL_LABEL)).otherwise(F.col(b)).alias(b),
                    "count"))


def _pair_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    # pd.crosstab without fillna drops rows with a NULL in either column
    return (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
            .groupBy(F.col(a).cast("string").alias(a), F.col(b).cast("string").alias(b))
            .agg(F.count(F.lit(1)).alias("count")))


def _with_total(cells: DataFrame, by: str) -> DataFrame:
    """Cells with the total of their level of ``by``: grouped sums joined back, so that no
    level's cells have to fit one task."""
    cells = staged(cells, "cells")
    return sized_join(cells, cells.groupBy(by).agg(F.sum("count").alias("__total")), by, "inner")


def crosstab_row_pct(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cell percent of its row total, rounded half-to-even to whole percent."""
    return _with_total(_pair_counts(df, a, b), a).select(a, b, "count", F.bround(F.col("count") * 100.0 / F.col("__total"), 0).alias("row_pct"))


def crosstab_col_share(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cell share of its column total (``normalize='columns'``)."""
    return _with_total(_pair_counts(df, a, b), b).select(a, b, "count", (F.col("count") / F.col("__total")).alias("col_share"))


def corr_matrix(df: DataFrame, cols) -> DataFrame:
    """Pairwise-complete Pearson correlation, full square matrix in long form."""
    pairs = list(itertools.combinations(range(len(cols)), 2))
    one = df.agg(*[F.corr(F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")).alias(f"r{i}_{j}")
                   for i, j in pairs], F.count(F.lit(1)).alias("__n"))
    items = []
    for i, c in enumerate(cols):
        items.append(F.struct(F.lit(c).alias("v1"), F.lit(c).alias("v2"), F.lit(1.0).alias("value")))
    for i, j in pairs:
        for x, y in ((cols[i], cols[j]), (cols[j], cols[i])):
            items.append(F.struct(F.lit(x).alias("v1"), F.lit(y).alias("v2"),
                                  F.col(f"r{i}_{j}").cast("double").alias("value")))
    return one.select(F.inline(F.array(*items)))


def date_diff_matrix(df: DataFrame, cols, unit: str = "h") -> DataFrame:
    """Mean of (v1 - v2) over rows where both are present, in hours ('h') or
    days ('D'); diagonal 0.  Microsecond precision (Q4)."""
    scale = {"h": 3_600_000_000.0, "D": 86_400_000_000.0, "m": 60_000_000.0, "s": 1_000_000.0}[unit]
    pairs = [(i, j) for i in range(len(cols)) for j in range(len(cols)) if i < j]
    one = df.agg(*[F.avg(epoch_micros(cols[i]) - epoch_micros(cols[j])).alias(f"d{i}_{j}") for i, j in pairs])
    items = [F.struct(F.lit(c).alias("v1"), F.lit(c).alias("v2"), F.lit(0.0).alias("mean_diff")) for c in cols]
    for i, j in pairs:
        m = F.col(f"d{i}_{j}") / F.lit(scale)
        items.append(F.struct(F.lit(cols[i]).alias("v1"), F.lit(cols[j]).alias("v2"), m.alias("mean_diff")))
        items.append(F.struct(F.lit(cols[j]).alias("v1"), F.lit(cols[i]).alias("v2"), (-m).alias("mean_diff")))
    return one.select(F.inline(F.array(*items)))


def contingency_all_pairs(df: DataFrame, cols) -> DataFrame:
    """(v1, v2, x, y, count) for every unordered pair of nominal columns, one
    shuffle.  NULL is the level 'null' (``nan_replace_value='null'``)."""
    pairs = list(itertools.combinations(cols, 2))
    arr = F.array(*[F.struct(F.lit(a).alias("v1"), F.lit(b).alias("v2"), _txt(a).alias("x"), _txt(b).alias("y"))
                    for a, b in pairs])
    return (df.select(F.explode(arr).alias("p")).select("p.v1", "p.v2", "p.x", "p.y")
            .groupBy("v1", "v2", "x", "y").agg(F.count(F.lit(1)).alias("count")))


def _nominal_pairs(df: DataFrame, cols) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written contingency cells of all pairs with their row and column totals."""
    cells = staged(contingency_all_pairs(df, cols), "cells")
    rows = staged(cells.groupBy("v1", "v2", "x").agg(F.sum("count").alias("rt")), "cell_rows")
    columns = staged(cells.groupBy("v1", "v2", "y").agg(F.sum("count").alias("ct")), "cell_columns")
    return cells, rows, columns


def theils_u(df: DataFrame, cols, parts=None) -> DataFrame:
    """D32 nominal-nominal: Theil's U in both directions: (v1, v2, theils_u), the share of the
    entropy of v1 that v2 explains; 1 where v1 has one level only.

    H(v1) and H(v1 | v2) are grouped sums over the contingency cells: with counts c of a
    cell and t of its level of v2, H(v1 | v2) = (sum t ln t - sum c ln c) / n."""
    cells, rows, columns = parts or _nominal_pairs(df, cols)
    of = lambda t, c, name: t.groupBy("v1", "v2").agg(F.sum(F.col(c) * F.ln(c)).alias(name), F.sum(c).cast("double").alias("n"), F.count(F.lit(1)).alias(f"k_{name}"))
    one = (of(cells, "count", "both").join(of(rows, "rt", "first").drop("n"), ["v1", "v2"])
           .join(of(columns, "ct", "second").drop("n"), ["v1", "v2"]))  # one row per pair of columns
    top = F.col("n") * F.ln("n")

    def u(mine, other):  # (H(mine) - H(mine | other)) / H(mine)
        whole, left = top - F.col(mine), F.col(other) - F.col("both")
        return F.when(F.col(f"k_{mine}") == 1, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.try_divide(whole - left, whole)))
    return one.select(F.inline(F.array(F.struct(F.col("v1"), F.col("v2"), u("first", "second").alias("theils_u")),
                                       F.struct(F.col("v2").alias("v1"), F.col("v1").alias("v2"), u("second", "first").alias("theils_u")))))


def cramers_v(df: DataFrame, cols, parts=None) -> DataFrame:
    """D32 nominal-nominal: Cramér's V, plain and bias-corrected (Bergsma), per pair.

    chi2 = sum(O^2 / E) - n over the non-empty cells, E = row * col / n; the row and
    column totals are grouped sums of the written contingency cells, joined back, so
    no pair's table has to fit one task."""
    cells, rows, columns = parts or _nominal_pairs(df, cols)
    # chi2 + n = n * sum(O^2 / (row * column)): every part is a grouped sum
    share = (cells.join(rows, ["v1", "v2", "x"]).join(columns, ["v1", "v2", "y"])
             .groupBy("v1", "v2").agg(F.sum(F.col("count") * F.col("count") / (F.col("rt") * F.col("ct"))).alias("s")))
    # one row per pair of columns
    per = (share.join(rows.groupBy("v1", "v2").agg(F.sum("rt").cast("double").alias("n"), F.count(F.lit(1)).alias("r")), ["v1", "v2"])
           .join(columns.groupBy("v1", "v2").agg(F.count(F.lit(1)).alias("k")), ["v1", "v2"])
           .withColumn("chi2", F.col("n") * F.col("s") - F.col("n")))
    phi2 = F.col("chi2") / F.col("n")
    r, k, n_ = F.col("r"), F.col("k"), F.col("n")
    phi2c = F.greatest(F.lit(0.0), phi2 - (k - 1) * (r - 1) / (n_ - 1))
    rc = r - (r - 1) * (r - 1) / (n_ - 1)
    kc = k - (k - 1) * (k - 1) / (n_ - 1)
    return per.select(
        "v1", "v2",
        F.sqrt(F.try_divide(phi2, F.least(r, k) - 1)).alias("cramers_v"),
        F.sqrt(F.try_divide(phi2c, F.least(kc - 1, rc - 1))).alias("cramers_v_corrected"))


def correlation_ratio(df: DataFrame, nominal, numeric) -> DataFrame:
    """D32 nominal-numeric: eta = sqrt(SS_between / SS_total) from grouped sums.
    All (nominal, numeric) pairs come from one grouping of the unpivoted levels;
    rows with a NULL numeric value are left out of that pair.  Values are shifted by
    their mean first, so a large mean costs no digits."""
    means = df.agg(*[F.avg(F.col(y).cast("double")).alias(y) for y in numeric]).first()
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("nominal"), _txt(c).alias("level")) for c in nominal]))
    g = (df.select(kv.alias("kv"), *[(F.col(y).cast("double") - F.lit(means[y])).alias(y) for y in numeric])
         .select("kv.nominal", "kv.level", *numeric)
         .groupBy("nominal", "level")
         .agg(*[a for y in numeric for a in (F.count(y).alias(f"{y}__n"), F.sum(y).alias(f"{y}__s"),
                                              F.sum(F.col(y) * F.col(y)).alias(f"{y}__q"))]))
    long = g.select("nominal", "level", F.inline(F.array(*[
        F.struct(F.lit(y).alias("numeric"), F.col(f"{y}__n").alias("n"), F.col(f"{y}__s").alias("s"),
                 F.col(f"{y}__q").alias("q")) for y in numeric])))
    per = long.where(F.col("n") > 0).groupBy("nominal", "numeric").agg(
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between_raw"),
        F.sum("n").cast("double").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    ss_b = F.col("between_raw") - F.col("s") * F.col("s") / F.col("n")
    ss_t = F.col("q") - F.col("s") * F.col("s") / F.col("n")
    return per.select(F.col("nominal").alias("v1"), F.col("numeric").alias("v2"),
                      F.sqrt(F.greatest(F.lit(0.0), F.try_divide(ss_b, ss_t))).alias("eta"))


def association_matrix(df: DataFrame, nominal, numeric) -> DataFrame:
    """Long (v1, v2, measure, value) over the mixed column set."""
    parts = []
    if len(nominal) > 1:
        tables = _nominal_pairs(df, nominal)
        cv = cramers_v(df, nominal, tables)
        parts.append(cv.select("v1", "v2", F.lit("cramers_v").alias("measure"), F.col("cramers_v").alias("value")))
        parts.append(cv.select("v1", "v2", F.lit("cramers_v_corrected").alias("measure"),
                               F.col("cramers_v_corrected").alias("value")))
        parts.append(theils_u(df, nominal, tables).select("v1", "v2", F.lit("theils_u").alias("measure"), F.col("theils_u").alias("value")))
    if nominal and numeric:
        parts.append(correlation_ratio(df, nominal, numeric).select(
            "v1", "v2", F.lit("eta").alias("measure"), F.col("eta").alias("value")))
    if len(numeric) > 1:
        pairs = list(itertools.combinations(numeric, 2))
        one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}")
                       for i, (a, b) in enumerate(pairs)])
        parts.append(one.select(F.inline(F.array(*[
            F.struct(F.lit(a).alias("v1"), F.lit(b).alias("v2"), F.lit("pearson").alias("measure"),
                     F.col(f"r{i}").alias("value")) for i, (a, b) in enumerate(pairs)]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def density_2d(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Counts on a bins x bins grid over the [min, max] box (last bin closed)."""
    mm = df.agg(F.min(x).cast("double"), F.max(x).cast("double"),
                F.min(y).cast("double"), F.max(y).cast("double")).first()
    if mm[0] is None or mm[2] is None:
        return df.sparkSession.createDataFrame([], "bin_x int, bin_y int, count long")

    def idx(c, lo, hi):
        w = (hi - lo) / bins if hi > lo else 1.0
        return F.least(F.floor((F.col(c).cast("double") - F.lit(lo)) / F.lit(w)).cast("int"), F.lit(bins - 1))
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(idx(x, mm[0], mm[1]).alias("bin_x"), idx(y, mm[2], mm[3]).alias("bin_y"))
            .agg(F.count(F.lit(1)).alias("count")))




def density_pairs(df: DataFrame, cols, bins: int = 20) -> DataFrame:
    """D33 (scatter matrix input): 2-D binned counts for every pair of numeric
    columns.  One aggregate gives all min/max; one explode of (pair, bin_x,
    bin_y) and one grouped count (combined map-side) give all grids."""
    mm = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(cols)
                  for n, f in (("lo", F.min), ("hi", F.max))]).first()

    def idx(i):
        lo, hi = mm[f"lo{i}"], mm[f"hi{i}"]
        if lo is None:
            return F.lit(None).cast("int")
        w = (hi - lo) / bins if hi > lo else 1.0
        return F.least(F.floor((F.col(cols[i]).cast("double") - F.lit(lo)) / F.lit(w)).cast("int"), F.lit(bins - 1))
    pairs = list(itertools.combinations(range(len(cols)), 2))
    arr = F.array(*[F.struct(F.lit(cols[i]).alias("v1"), F.lit(cols[j]).alias("v2"), idx(i).alias("bin_x"),
                             idx(j).alias("bin_y")) for i, j in pairs])
    return (df.select(F.explode(arr).alias("p")).select("p.*")
            .where(F.col("bin_x").isNotNull() & F.col("bin_y").isNotNull())
            .groupBy("v1", "v2", "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("count")))
