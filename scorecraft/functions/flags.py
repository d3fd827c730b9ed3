"""Derived indicator columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def target_from_score(score: str = "raw_score") -> Column:
    """1 when the score is positive, else 0 (NULL -> 0, Q6)."""
    return F.when(F.col(score) > 0, 1).otherwise(0)


def zero_flag_yes_no(c: str = "final_score_unweighted") -> Column:
    """B6: 'Yes' when zero, else 'No' (NULL -> 'No')."""
    return F.when(F.col(c) == 0, "Yes").otherwise("No")


def zero_flag_null_yes_no(c: str = "raw_score") -> Column:
    """B7: 'Null' / 'Yes' / 'No'."""
    return (F.when(F.col(c).isNull(), "Null")
            .when(F.col(c) == 0, "Yes").otherwise("No"))
