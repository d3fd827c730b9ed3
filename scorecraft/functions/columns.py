"""Column selection, relabelling and long-form reshaping."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def select_cols(df: DataFrame, include=None, exclude=None) -> DataFrame:
    """Allow-list then deny-list; an empty/None list keeps everything."""
    cols = df.columns
    if include:
        keep = set(include)
        cols = [c for c in cols if c in keep]
    if exclude:
        drop = set(exclude)
        cols = [c for c in cols if c not in drop]
    return df.select(*cols)


def drop_id_columns(df: DataFrame, pattern: str = r"_id$") -> DataFrame:
    """Drop identifier columns by name pattern and sort the remaining names."""
    rx = re.compile(pattern)
    return df.select(*sorted(c for c in df.columns if not rx.search(c)))


def relabel(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns with a field -> label map (unknown names stay)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def to_long(df: DataFrame, ids, values, variable: str = "variable", value: str = "value") -> DataFrame:
    """The transpose of a per-column result, as ``unpivot`` (long form)."""
    return df.unpivot(list(ids), list(values), variable, value)
