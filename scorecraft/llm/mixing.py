"""Mixing sources to target weights.

Targets by capped water-filling: the total is shared among the sources by weight;
a source whose share passes ``max_epochs`` times its size is clamped there, and
what it leaves is shared again among the others by weight, until none is above.
All that a round passes on is one number, the level (target per unit of weight).

Then each source takes every document a whole number of times and the rest of its
target as a seeded selection: documents are dealt into 4096 slots by a hash of
their id; slots are gone through in order, and each is taken that leaves the words
within the target, those after one that does not fit as well; of the others the one
nearest in size to what is missing fills the gap, if it brings the sum nearer.  A source
then misses its target by half of its smallest slot not taken at most.  Sums
per source and slot are combined before the shuffle, so a source with a third of
all rows is harmless."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorecraft.llm.staging import staged
from scorecraft.operators.joins import sized_join

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _name(source: Column) -> Column:
    """Source as a join key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def slot(doc_id: Column, seed: str) -> Column:
    """0 to 4095: the first three hex digits of md5(seed, id)."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 3), 16, 10).cast("int")


def targets(sizes: DataFrame, max_epochs: int, total: float | None = None) -> DataFrame:
    """``sizes`` (one row per source: source_size, weight) with the column target."""
    caps = sizes.withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
    level, clamped = 0.0, -1
    while True:
        under = F.col("cap") <= F.lit(level) * F.col("weight")
        row = caps.agg(F.sum("source_size").alias("all"), F.sum(F.when(under, F.col("cap"))).alias("gone"),
                       F.sum(F.when(~under, F.col("weight"))).alias("open"), F.sum(under.cast("int")).alias("n")).head()
        if not row["open"] or row["n"] == clamped:
            break
        clamped = row["n"]
        level = max(0.0, float(total if total is not None else row["all"]) - float(row["gone"] or 0)) / float(row["open"])
    return caps.withColumn("target", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))).drop("cap")


def ranked_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``sources`` (one row per source) with weights dealt out in code-point order, null last."""
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (at % len(weights) + 1).cast("int")))


def mix(docs: DataFrame, weights=ranked_weights, max_epochs: int = 3, total: float | None = None, seed: str = "mix",
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: tuple | list = ()) -> DataFrame:
    """One row per row of ``docs``: id_col, the columns ``keep``, source, size (words), source_size, target
    (words of its source), repeats (how often the mix takes it) and taken
    (repeats * size).  ``weights`` gets the frame of sources (source, source_size,
    one row each) and returns it with the column weight; ``total`` words are shared
    out (default: those of the input).

    Cases: null text has size 0; null is a source of its own; a source without words
    has target 0 and its documents 0 repeats; rows that repeat an id are taken
    alike; an empty table gives an empty result; other columns are not read."""
    sized = staged(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                               _name(F.col(source_col)).alias("key"), slot(F.col(id_col), seed).alias("slot"), F.struct(F.lit(0), *map(F.col, keep)).alias("__keep")), "mix")
    slots = sized.groupBy("key", "slot").agg(F.sum("size").alias("words"), F.first("source").alias("source"))
    slots = staged(slots, "mix_slots")  # at most 4096 rows a source
    sources = slots.groupBy("key").agg(F.sum("words").alias("source_size"), F.first("source").alias("source"))
    goals = staged(targets(staged(weights(sources), "mix_sources"), max_epochs, total), "mix_targets")
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = goals.withColumn("whole", F.floor(epochs)).withColumn("goal", F.col("target") - F.col("whole") * F.col("source_size"))
    lists = slots.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("slot", "words"))).alias("slots"))  # at most 4096 slots
    lists = sized_join(lists, goals.where("goal > 0").select("key", "goal"), "key", "inner")
    # slots that do not fit are kept in the order they were passed
    start = F.struct(F.lit(0).cast("long").alias("filled"), F.array().cast("array<struct<slot:int,words:bigint>>").alias("passed"))
    fits = lambda s, x: s["filled"] + x["words"] <= F.col("goal")
    walk = F.aggregate("slots", start, lambda s, x: F.when(fits(s, x), F.struct((s["filled"] + x["words"]).alias("filled"), s["passed"].alias("passed")))
                       .otherwise(F.struct(s["filled"].alias("filled"), F.concat(s["passed"], F.array(x)).alias("passed"))))
    gap = F.col("goal") - F.col("w.filled")
    near = F.array_min(F.transform("w.passed", lambda x: F.struct(F.abs(x["words"] - gap).alias("off"), x["slot"].alias("slot"))))
    picked = (lists.withColumn("w", walk).withColumn("near", near)
              .select("key", F.transform("w.passed", lambda x: x["slot"]).alias("passed"), F.when(F.col("near.off") < gap, F.col("near.slot")).alias("fill")))
    table = sized_join(goals, staged(picked, "mix_picked"), "key", "left", written=True).select("key", "source_size", "target", "whole", "goal", "passed", "fill")
    out = sized_join(sized, table, "key", "inner")
    more = (F.col("goal") > 0) & (~F.array_contains("passed", F.col("slot")) | F.coalesce(F.col("slot") == F.col("fill"), F.lit(False)))
    repeats = F.col("whole") + more.cast("long")
    return out.select(F.col("id").alias(id_col), *[F.col(f"__keep.{c}") for c in keep], "source", "size", "source_size", "target", repeats.alias("repeats"), (repeats * F.col("size")).alias("taken"))
