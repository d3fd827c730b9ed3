"""Streaming ingest of item attempts: clean rows as they arrive, and maintain
per-category event counts.

Sources are parquet files (schema taken from the existing files, no inference
per batch); sinks are parquet folders; checkpoints live in the shared folder,
so a restarted query resumes exactly once from the last committed batch."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorecraft.session import checkpoint_dir
from scorecraft.sources.attempts import attempts_view


def read_attempt_stream(spark: SparkSession, source: str, max_files: int | None = None) -> DataFrame:
    schema = spark.read.parquet(source).schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return attempts_view(r.parquet(source))


def clean_stream(spark: SparkSession, source: str, sink: str, checkpoint: str | None = None,
                 available_now: bool = True) -> DataFrame:
    """C1 -> C5 -> B3 -> B5 on every new file; appended to ``sink`` (parquet).
    Returns the sink read back as a batch DataFrame once the stream is drained."""
    from scorecraft.plans.prep import study_frame
    rows = study_frame(read_attempt_stream(spark, source))
    ck = checkpoint or os.path.join(checkpoint_dir(spark), "streams", os.path.basename(sink.rstrip("/")))
    w = (rows.writeStream.format("parquet").option("checkpointLocation", ck).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    q = w.start(sink)
    if available_now:
        q.awaitTermination()
    return spark.read.parquet(sink)


def event_count_stream(spark: SparkSession, source: str, sink: str, category: str = "item_type_code_name",
                       checkpoint: str | None = None) -> DataFrame:
    """Running (category, n_event, n_nonevent) over the cleaned stream.  The
    state is one row per category held by Spark's state store; each
    micro-batch rewrites the small result table with ``foreachBatch``."""
    from scorecraft.plans.prep import study_frame
    rows = study_frame(read_attempt_stream(spark, source))
    counts = rows.groupBy(category).agg(F.count_if(F.col("target") == 1).alias("n_event"),
                                        F.count_if(F.col("target") == 0).alias("n_nonevent"))
    ck = checkpoint or os.path.join(checkpoint_dir(spark), "streams", os.path.basename(sink.rstrip("/")))

    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    q = (counts.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)
