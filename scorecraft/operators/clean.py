"""Row filters and the checks around them.

Filters are written on the raw columns so that Catalyst pushes them into the
parquet scan; a filter on a column dropped by a projection is applied before
the projection (Q10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecraft.operators.joins import sized_join

# Status and marker strings of the source system.
FULLY_SCORED = "fully scored"
UNASSIGNED = "[unassigned]"


def keep_scored(df: DataFrame, id_col: str = "assessment_item_response_id",
                status_col: str = "learner_attempt_status") -> DataFrame:
    """Answered and fully scored rows."""
    return df.filter(F.col(id_col).isNotNull() & (F.col(status_col) == FULLY_SCORED))


def keep_dates_present(df: DataFrame, cols, how: str = "any") -> DataFrame:
    """C2 (how='any': at least one present, Q8) / C3 (how='all': all present)."""
    conds = [F.col(c).isNotNull() for c in cols]
    cond = conds[0]
    for c in conds[1:]:
        cond = (cond | c) if how == "any" else (cond & c)
    return df.filter(cond)


def keep_ordered(df: DataFrame, start: str, end: str) -> DataFrame:
    """Keep start <= end (NULL in either drops the row)."""
    return df.filter(F.col(start) <= F.col(end))


def drop_value_keep_null(df: DataFrame, col: str, value=UNASSIGNED) -> DataFrame:
    """Drop one value but keep NULLs."""
    return df.filter(F.col(col).isNull() | (F.col(col) != value))


def drop_null(df: DataFrame, col: str) -> DataFrame:
    """C8."""
    return df.filter(F.col(col).isNotNull())


def filter_then_project(df: DataFrame, predicate: Column, cols) -> DataFrame:
    """Filter on columns the projection removes: filter first (Q10)."""
    return df.filter(predicate).select(*cols)


def before_cutoff(df: DataFrame, col: str, cutoff: str) -> DataFrame:
    """C14: rows strictly before a cutoff date (literal, pushed to the scan)."""
    return df.filter(F.col(col) < F.lit(cutoff).cast(df.schema[col].dataType))


def entity_lookup(df: DataFrame, key: str, value, cols, order_by=None) -> DataFrame:
    """One entity's columns, distinct, optionally ordered."""
    out = df.filter(F.col(key) == value).select(*cols).distinct()
    return out.orderBy(*(order_by or cols))


def complete_rows(df: DataFrame, cols=None) -> DataFrame:
    """Rows without any NULL (in ``cols``, default all columns).  Written as
    a conjunction of IS NOT NULL tests, which the parquet reader receives as
    pushed filters (``dropna``'s at-least-n-non-nulls predicate is not pushed)."""
    cond = F.lit(True)
    for c in (cols or df.columns):
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def remove_bad_ids(df: DataFrame, bad: Column, id_col: str = "assessment_item_response_id") -> DataFrame:
    """Drop every row whose id has at least one offending row.

    Offending ids are collected as a distinct DataFrame (not a driver list) and
    removed with a left-anti join, broadcast only when the id set is small.
    Unlike the literal IN-list form, NULL ids are kept (Q13)."""
    ids = df.filter(bad).select(id_col).where(F.col(id_col).isNotNull()).distinct()
    return sized_join(df, ids, id_col, "left_anti")


def row_loss(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows a filter would remove and keep, in one pass."""
    keep = F.coalesce(predicate, F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("before"), F.count_if(keep).alias("kept"),
                  F.count_if(~keep).alias("removed"))
