"""Corpus pipeline: quality filter, exact dedup, SimHash near-dedup, mixing, token ids.

Each stage calls one operator of ``scorecraft.llm`` on the documents that the stage
before it kept.  Decisions are applied row by row, so repeated and null ids are
documents like any other.  All but the last return the columns of ``documents``; the last
returns doc_id, ids and n_tokens for every document that the mix takes, as often as
it takes it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorecraft.llm.bpe import encode
from scorecraft.llm.exact_dedup import exact_dedup
from scorecraft.llm.mixing import mix
from scorecraft.llm.quality import fit_quality, score_quality
from scorecraft.llm.simhash import simhash_dedup
from scorecraft.llm.staging import staged
from scorecraft.operators.joins import sized_join

# Documents whose score is lower are rejected.
LOWEST_SCORE = 0.3
SHINGLE, MAX_BITS = 3, 3

# The network has no SQL form; tests/llm runs the stages against brute-force versions.
ORACLE_SQL = None


def _keyed(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a key of its own for every row, written so that it stays the same."""
    return staged(docs.withColumn("__row", F.monotonically_increasing_id()), name)


def _without(docs: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """``docs`` (with __row) less the rows ``gone`` (__row); their keys are sent to the
    documents where their measured size allows it."""
    return sized_join(docs, staged(gone.select("__row"), name), "__row", "left_anti", written=True).drop("__row")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score under LOWEST_SCORE, by a network that is fitted on
    the labelled documents among these (rows of the held-out fifth aside)."""
    network = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_quality(docs.withColumn("__body", F.col("text")), network, "doc_id", "__body", keep=docs.columns)
    return scored.where(F.col("score") >= LOWEST_SCORE).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of equal texts, whatever the rows' ids."""
    docs = _keyed(docs, "exact_rows")
    return _without(docs, exact_dedup(docs, keep=["__row"]).where("not kept"), "exact_gone")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of linked fingerprints: that of the smallest id."""
    docs = _keyed(docs, "near_rows")
    judged = simhash_dedup(docs, SHINGLE, MAX_BITS, id_col="__row", keep=["doc_id"])
    judged = staged(judged.select("__row", "doc_id", F.col("component_id").alias("component")), "near")
    first = judged.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row")).alias("first"), F.count("*").alias("n"))
    first = staged(first.where("n > 1").select("component", F.col("first.__row").alias("stays")), "near_first")
    return _without(docs, sized_join(judged.select("__row", "component"), first, "component", "inner", written=True).where("__row <> stays"), "near_gone")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them (0 to 3 times)."""
    docs = _keyed(docs, "mix_rows")
    plan = mix(docs, keep=["__row"]).where("repeats > 0").select("__row", F.col("repeats").cast("int").alias("__times"))
    taken = sized_join(docs, staged(plan, "mix_plan"), "__row", "inner", written=True).drop("__row")
    return taken.withColumn("__time", F.explode(F.sequence(F.lit(1), F.col("__times")))).drop("__time", "__times")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    ids = encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality", quality), ("exact_dedup", exact), ("simhash_dedup", near), ("mixing", mixture), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on ``documents``; each result but the last is written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
