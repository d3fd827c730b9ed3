"""Sources and sinks: parquet/CSV readers and writers, the data dictionary and
the ``attempts`` fact view derived from the supplied tables."""

from scorecraft.sources.tables import load_table, load_tables, TABLES
from scorecraft.sources.attempts import attempts
from scorecraft.sources.dictionary import dictionary_df

__all__ = ["load_table", "load_tables", "TABLES", "attempts", "dictionary_df"]
