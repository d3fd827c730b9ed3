"""Written tables in the shared checkpoint folder, which cut lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scorecraft.session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet into the folder of spark.checkpoint.dir and
    read back: later steps survive lost executors without computing it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
