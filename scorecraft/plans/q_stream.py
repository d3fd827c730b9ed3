"""Catalogue: the row-level cleaning and the event counts as streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorecraft.plans.catalog import att_path, query
from scorecraft.plans.oracle import STUDY_CTE, with_attempts
from scorecraft.session import scratch_path
from scorecraft.streaming import ingest


@query("stream_clean", with_attempts("""
SELECT org_id, count(*) AS n_rows, CAST(sum(target) AS BIGINT) AS n_target FROM study GROUP BY org_id""", STUDY_CTE))
def q_stream_clean(spark, sf):
    """Structured Streaming: C1 -> C5 -> B3 -> B5 over the staged fact files
    (availableNow trigger, checkpointed), read back and counted per organisation."""
    out = ingest.clean_stream(spark, att_path(spark, sf), scratch_path(spark, "stream_clean"))
    return out.groupBy("org_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("target").cast("long").alias("n_target"))


@query("stream_event_counts", with_attempts("""
SELECT item_type_code_name, count_if(target = 1) AS n_event, count_if(target = 0) AS n_nonevent
FROM study GROUP BY item_type_code_name""", STUDY_CTE))
def q_stream_event_counts(spark, sf):
    """Structured Streaming: stateful per-category event counts (complete mode, foreachBatch sink)."""
    return ingest.event_count_stream(spark, att_path(spark, sf), scratch_path(spark, "stream_counts"))
