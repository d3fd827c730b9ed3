"""CSV scan with an explicit schema, parquet staging and
sink, tables from local rows, and the schema report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorecraft.session import staged


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, infer: bool = False) -> DataFrame:
    """A1: CSV with header.  An explicit schema avoids the extra inference pass
    over the whole input; ``infer=True`` reproduces ``inferSchema``."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
                          sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """A1: (good rows, rejected lines) of a CSV file: a line with too few or too many fields, or
    with a field that is not of its column's type, is rejected whole and kept as it stands in
    column ``line``, beside its file.  The parsed lines are written once, so both results
    agree and the file is parsed once."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    mark = "__line"
    while mark in schema.names:
        mark += "_"
    parsed = (spark.read.schema(T.StructType([*schema.fields, T.StructField(mark, T.StringType())]))
              .option("header", header).option("sep", sep).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", mark).csv(path))
    parsed = staged(parsed.select("*", F.col("_metadata.file_name").alias(f"{mark}_file")), "csv")
    return (parsed.where(F.col(mark).isNull()).drop(mark, f"{mark}_file"),
            parsed.where(F.col(mark).isNotNull()).select(F.col(f"{mark}_file").alias("file"), F.col(mark).alias("line")))


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).csv(path)


def write_parquet(df: DataFrame, path: str, num_files: int | None = None,
                  partition_by: list[str] | None = None, options: dict[str, str] | None = None) -> None:
    """A5: overwrite sink.  No forced single file (Q1): ``num_files`` is opt-in
    and uses ``coalesce`` (no shuffle).  ``options`` are those of the Parquet writer."""
    if num_files:
        df = df.coalesce(num_files)
    w = df.write.mode("overwrite").options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def stage_parquet(spark: SparkSession, df: DataFrame, path: str, **kw) -> DataFrame:
    """A3: persist a scan as parquet and continue from the written copy, which
    also cuts the lineage (the copy lives in the shared folder)."""
    write_parquet(df, path, **kw)
    return spark.read.parquet(path)


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """A (small, driver-sized) table from local rows."""
    return spark.createDataFrame(rows, schema)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, Spark type, non-null count, null count.

    One aggregate pass over the data computes all non-null counts; the schema
    part is metadata joined by position."""
    cols = df.columns
    n_rows = F.count(F.lit(1)).alias("__n")
    counts = df.agg(n_rows, *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
    spark = df.sparkSession
    meta = spark.createDataFrame(
        [(i, c, df.schema[c].dataType.simpleString()) for i, c in enumerate(cols)],
        "position int, column string, data_type string")
    stack = counts.select(
        F.col("__n"),
        F.inline(F.array(*[F.struct(F.lit(i).alias("position"), F.col(f"c{i}").alias("non_null"))
                           for i in range(len(cols))])))
    return (meta.join(F.broadcast(stack), "position")
            .select("position", "column", "data_type",
                    F.col("non_null").cast("long").alias("non_null"),
                    (F.col("__n") - F.col("non_null")).cast("long").alias("nulls")))
