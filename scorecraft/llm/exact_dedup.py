"""Exact duplicates by a content sort (DataFrame functions only).

Texts are compared after every run of blanks, tabs and line ends became one
space.  A sample of the rows gives splitters; every row goes to the range between
two splitters, is sorted there by (normalised text, id) - Spark's external sort -
and is compared in full with its neighbour: equal texts form a run.

Splitter key: the text's first characters, its hash, the document id.  A long
common beginning is thus cut by the hash, and a text with very many copies by
the id, so no group lands in one range whole.  Only a text that equals a splitter
can lie in two ranges; the runs of those texts, at most two a range, are merged
by their full text afterwards.  The text is shuffled once."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorecraft.llm.staging import staged

# Ranges per shuffle partition and sampled rows per range: so many keys of at most
# PREFIX characters reach the driver and are sent out as splitters.
RANGES_PER_PARTITION, SAMPLED, PREFIX = 4, 8, 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _key(norm: Column, doc: Column) -> Column:
    return F.struct(F.substring(norm, 1, PREFIX).alias("p"), F.xxhash64(norm).alias("h"), doc.alias("i"))


def _splitters(docs: DataFrame, id_col: str, text_col: str) -> list:
    n = docs.count()
    wanted = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = docs.sample(min(1.0, wanted * SAMPLED / max(n, 1)), 7)
    keys = [r[0] for r in sample.select(_key(normalised(F.col(text_col)), F.col(id_col))).collect()]
    keys.sort(key=lambda k: (k.p.encode(), k.h, k.i is not None, k.i))
    return keys[SAMPLED - 1::SAMPLED]


def _range(key: Column, splitters: Column, n: int) -> Column:
    """How many splitters are at most ``key``: a binary search by falling powers of two."""
    powers = F.array(*[F.lit(1 << k) for k in range(n.bit_length() - 1, -1, -1)] or [F.lit(0)])
    start = F.struct(F.lit(0).alias("n"), key.alias("k"))
    step = lambda s, p: F.struct(
        F.when(F.get(splitters, s["n"] + p - 1) <= s["k"], s["n"] + p).otherwise(s["n"]).alias("n"), s["k"].alias("k"))
    return F.aggregate(powers, start, step, lambda s: s["n"])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple | list = ()) -> DataFrame:
    """One row per row of ``docs``: id_col, the columns ``keep``, keep_id (smallest id of the equal texts),
    group_size, kept (true for exactly one row of each group) and text_sha256.

    Cases: null text equals empty text; null ids come after all others (keep_id is
    null only where the whole group has none); of rows that repeat an id and text
    one is kept; an empty table gives an empty result; only the id and text
    columns and ``keep`` are read, so others may have any name."""
    spark = docs.sparkSession
    found = _splitters(docs, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    # read back as one folded literal
    splitters = F.from_json(F.lit(json.dumps([k.asDict() for k in found], default=str)), f"array<struct<p:string,h:bigint,i:{id_type}>>")
    kept = F.struct(F.lit(0), *map(F.col, keep)).alias("__keep")
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"), kept).withColumn("key", _key(F.col("norm"), F.col("id")))
    ranged = rows.withColumn("range", _range(F.col("key"), splitters, len(found))).select("id", "norm", "__keep", "range", "key.p", "key.h")
    touches = lambda s: F.coalesce((s["p"] == F.col("p")) & (s["h"] == F.col("h")), F.lit(False))
    w = Window.partitionBy("range").orderBy("norm", F.col("id").asc_nulls_last())
    first = F.coalesce(F.col("before") != F.col("norm"), F.lit(True))
    runs = (ranged.withColumn("before", F.lag("norm").over(w)).withColumn("first", first.cast("long"))
            .withColumn("run", F.sum("first").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("edge", touches(F.get(splitters, F.col("range") - 1)) | touches(F.get(splitters, F.col("range")))))
    narrow = staged(runs.select("id", "__keep", "range", "run", (F.col("first") == 1).alias("first"), "edge", F.sha2("norm", 256).alias("sha"),
                                F.when(F.col("edge") & (F.col("first") == 1), F.col("norm")).alias("text")), "exact_dedup")
    # runs of the texts that may lie in several ranges: at most two a range
    parts = narrow.where("edge").groupBy("range", "run").agg(F.min("id").alias("low"), F.count("*").alias("n"), F.max("text").alias("text"))
    same = Window.partitionBy("text")
    merged = parts.select("range", "run", F.min("low").over(same).alias("all_low"), F.sum("n").over(same).alias("all_n"),
                          (F.row_number().over(same.orderBy(F.col("low").asc_nulls_last(), "range")) == 1).alias("holds"))
    own = Window.partitionBy("range", "run")
    out = (narrow.drop("text", "edge").withColumn("low", F.min("id").over(own)).withColumn("n", F.count("*").over(own))
           .join(F.broadcast(merged), ["range", "run"], "left"))
    return out.select(F.col("id").alias(id_col), *[F.col(f"__keep.{c}") for c in keep], F.when(F.col("holds").isNull(), F.col("low")).otherwise(F.col("all_low")).alias("keep_id"),
                      F.coalesce("all_n", "n").alias("group_size"),
                      (F.col("first") & F.coalesce("holds", F.lit(True))).alias("kept"), F.col("sha").alias("text_sha256"))
