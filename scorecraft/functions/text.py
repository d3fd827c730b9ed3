"""Text helpers as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def initials(c: Column) -> Column:
    """Lower-case first letters of the whitespace-separated words: 'Item Attempt' -> 'ia'."""
    words = F.split(F.trim(c), r"\s+")
    return F.array_join(F.transform(words, lambda w: F.lower(F.substring(w, 1, 1))), "")


def initials_label(c: Column) -> Column:
    """Initials wrapped in parentheses: 'Item Attempt' -> '(ia)'."""
    return F.concat(F.lit("("), initials(c), F.lit(")"))
