"""Date-time casts, sentinel nulling, durations.

Timestamps in the supplied tables are TIMESTAMP_NTZ; epoch arithmetic goes
through ``timestamp`` (session zone UTC) because NTZ cannot be cast to a number
directly (Q4).  Whole-second truncation matches the reference's ``cast('long')``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default ("sentinel") dates used by the source system.
DEFAULT_DATES = ["2999-01-01 00:00:00", "1900-01-01 00:00:00"]
# Months from the as-of date beyond which a date is a sentinel.
SENTINEL_MONTHS = 30


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(c) -> Column:
    """Whole seconds since the epoch (E8); NULL stays NULL."""
    return F.unix_seconds(col_(c).cast("timestamp"))


def epoch_micros(c) -> Column:
    return F.unix_micros(col_(c).cast("timestamp"))


def cast_timestamps(df: DataFrame, cols) -> DataFrame:
    """B1: bulk string -> timestamp in one projection; unparsable text -> NULL (Q2)."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c).cast("string")) for c in cols})


def null_sentinel(c, as_of) -> Column:
    """B2: NULL when the date is more than 30 months from ``as_of`` (Q3: explicit as-of)."""
    as_of_c = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    return F.when(F.abs(F.months_between(col_(c).cast("timestamp"), as_of_c)) > SENTINEL_MONTHS,
                  F.lit(None)).otherwise(col_(c))


def null_sentinel_dates(df: DataFrame, cols, as_of) -> DataFrame:
    return df.withColumns({c: null_sentinel(c, as_of) for c in cols})


def minutes_between(end, start) -> Column:
    return (epoch_seconds(end) - epoch_seconds(start)) / 60.0


def add_durations(df: DataFrame) -> DataFrame:
    """The three attempt durations in minutes.

    Timeliness is due date minus *start* (Q5), as in the study."""
    return df.withColumns({
        "item_attempt_duration_mins": minutes_between("item_attempt_end_datetime_utc",
                                                      "item_attempt_start_datetime_utc"),
        "student_duration_mins": minutes_between("student_stop_datetime", "student_start_datetime"),
        "timeliness_duration_mins": minutes_between("assignment_due_date", "student_start_datetime"),
    })


def drop_default_dates(df: DataFrame, a: str, b: str) -> DataFrame:
    """C4: drop rows holding a default date in either column (NULLs drop as well)."""
    dflt = [F.lit(d).cast("timestamp") for d in DEFAULT_DATES]
    return df.filter(~F.col(a).cast("timestamp").isin(*dflt) & ~F.col(b).cast("timestamp").isin(*dflt))


def date_stats(df: DataFrame, a: str, b: str) -> DataFrame:
    """Difference a - b in days, hours and minutes after dropping default dates."""
    secs = epoch_seconds(a) - epoch_seconds(b)
    return drop_default_dates(df, a, b).select(
        (secs / 86400.0).alias("days"), (secs / 3600.0).alias("hours"), (secs / 60.0).alias("minutes"))
