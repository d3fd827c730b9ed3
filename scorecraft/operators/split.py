"""Samples and train/validation splits.

The default split is a hash of a key, so a row's side never depends on the
partitioning or on a recomputation after an executor is lost (Q21).  The
native ``sample``/``randomSplit`` are offered as in the study; give
``checkpoint=True`` where the input's partitions can change on recomputation.
The stratified split is exact per class: counts by the leading part of the hash name
the part that holds a class's cut-off.  All other rows are decided by their hash alone;
that part's rows (1 / HASH_PARTS of a class) are ranked over ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorecraft.operators.joins import sized_join
from scorecraft.session import cut_lineage, staged

# Seeds and proportions used by the study.
SAMPLE_SEED = 8764664
SPLIT_SEED = 11112020
TRAIN_FRACTION = 0.75
SAMPLE_FRACTION = 0.10
# Parts of the hash by which the rows of a class are counted.
HASH_PARTS = 4096


def key_text(keys) -> Column:
    cols = [F.col(k).cast("string") for k in keys]
    return cols[0] if len(cols) == 1 else F.concat_ws("|", *cols)


def hash_unit(keys, method: str = "md5") -> Column:
    """A deterministic double in [0, 1).  ``md5`` (its first 52 bits) gives the same
    number in other engines (the SQL oracle); ``xxhash64`` is Spark's cheaper native
    hash for production splits where that is not needed."""
    if method == "xxhash64":
        h = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(2 ** 52)).cast("double")
    else:
        h = F.conv(F.substring(F.md5(key_text(keys)), 1, 13), 16, 10).cast("double")
    return h / F.lit(float(2 ** 52))


def hash_sample(df: DataFrame, keys, fraction: float = SAMPLE_FRACTION, method: str = "md5") -> DataFrame:
    """S1 (deterministic): rows whose hash is below ``fraction``."""
    return df.filter(hash_unit(keys, method) < fraction)


def hash_split(df: DataFrame, keys, train_fraction: float = TRAIN_FRACTION, col: str = "split",
               method: str = "md5") -> DataFrame:
    """S2 (deterministic): 'train' when the hash is below ``train_fraction``, else 'valid'."""
    return df.withColumn(col, F.when(hash_unit(keys, method) < train_fraction, "train").otherwise("valid"))


def native_sample(df: DataFrame, fraction: float = SAMPLE_FRACTION, seed: int = SAMPLE_SEED,
                  checkpoint: bool = False) -> DataFrame:
    """S1 as in the study (Bernoulli, fixed seed).  Over a deterministic input
    (a file scan, filters, projections, hash shuffles) a recomputed partition
    yields the same sample; set ``checkpoint`` when the input's partition
    contents can change on recomputation (round-robin repartition, sampling
    upstream), so the sample is drawn from a reliably checkpointed copy."""
    return (cut_lineage(df) if checkpoint else df).sample(False, fraction, seed)


def native_split(df: DataFrame, weights=(TRAIN_FRACTION, 1 - TRAIN_FRACTION), seed: int = SPLIT_SEED,
                 checkpoint: bool = False):
    """S2 as in the study (``randomSplit``, which sorts each partition so both
    halves agree); ``checkpoint`` as in ``native_sample``."""
    return (cut_lineage(df) if checkpoint else df).randomSplit(list(weights), seed)


def stratified_split(df: DataFrame, label: str, keys, train_fraction: float = TRAIN_FRACTION,
                     col: str = "split") -> DataFrame:
    """S3: exactly floor(train_fraction * n_c) rows of each class c (NULL is a class
    like any other) go to 'train': those with the smallest hash of the key, ties by
    the key's text and then by the whole row.

    One pass counts each class by the leading part of the hash; the counts name the one
    part that holds the class's cut-off, so all other rows are placed by their hash alone.
    The rows of that part are sorted over ranges, whose totals are the offsets of their
    ranks: a part that holds a whole class (many rows of one key) is ranked by many tasks."""
    u, name = hash_unit(keys), F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit(""))
    rows = df.withColumn("__class", name).withColumn("__u", u).withColumn("__part", F.floor(F.col("__u") * HASH_PARTS).cast("int"))
    counts = rows.groupBy("__class", "__part").agg(F.count(F.lit(1)).alias("__n"))
    end = F.sum("__n").over(Window.partitionBy("__class").orderBy("__part").rowsBetween(Window.unboundedPreceding, 0))  # HASH_PARTS rows at most
    taken = F.floor(F.lit(train_fraction) * F.sum("__n").over(Window.partitionBy("__class")))
    cuts = (counts.withColumn("__end", end).withColumn("__k", taken).where("__end > __k").groupBy("__class")
            .agg(F.min(F.struct("__part", (F.col("__k") - F.col("__end") + F.col("__n")).alias("need"))).alias("c"))
            .select("__class", F.col("c.__part").alias("__cut"), F.col("c.need").alias("__need")))
    placed = sized_join(rows, cuts, "__class", "left")  # no cut where all rows go to train
    train = F.col("__cut").isNull() | (F.col("__part") < F.col("__cut"))
    far = placed.where(train | (F.col("__part") > F.col("__cut"))).withColumn(col, F.when(train, "train").otherwise("valid"))
    order = ["__u", "__key", "__row"]
    near = (placed.where(F.col("__part") == F.col("__cut")).withColumn("__key", key_text(keys))
            .withColumn("__row", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])))
    near = staged(near.repartitionByRange("__class", *order).withColumn("__range", F.spark_partition_id()), "cutoff")
    totals = near.groupBy("__class", "__range").agg(F.count(F.lit(1)).alias("__t"))
    before = Window.partitionBy("__class").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = totals.select("__class", "__range", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__offset"))
    rank = F.col("__offset") + F.row_number().over(Window.partitionBy("__class", "__range").orderBy(*order))
    near = (near.join(offsets, ["__class", "__range"]).withColumn("__rank", rank)
            .withColumn(col, F.when(F.col("__rank") <= F.col("__need"), "train").otherwise("valid")))
    return far.select(*df.columns, col).unionByName(near.select(*df.columns, col))
