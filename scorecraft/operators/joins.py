"""J1, J5, B13 and the size-checked broadcast used by every lookup join.

A side is broadcast only after its row count is measured against a bound.  Beyond the
bound the join is a shuffle join, into which go only rows that may match: a bitmap of
hashed keys (Spark's bitmap aggregate, of a fixed size) is broadcast in the lookup
table's place, and rows whose bit is not set get their result without a shuffle.  Keys
that hold many rows of the left side are dealt over several tasks, each with a copy of
their lookup rows; adaptive execution splits what is still skewed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from scorecraft.session import staged

# A lookup table is broadcast only if it has at most this many rows AND at most this
# many measured bytes (every executor receives a copy).
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

# Rows of the left side from which the ones that may match are looked for, and bytes that such a
# row is taken to have at least.
LEAST_ROWS, LEAST_ROW_BYTES = 1000, 64
# Bits of the key filter (16 MB when all pages are in use), the share of them that may be set
# for it to be worth a look, and bits of one page (those of Spark's bitmap functions).
FILTER_BITS, FILTER_SHARE, PAGE_BITS = 1 << 27, 0.25, 32768
# A key is hot if it may hold this share of the rows; its rows are dealt over as many parts.
HOT_SHARE, HOT_PARTS = 0.02, 32

_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: 8 per fixed-width value, the real length of strings and binaries,
    the length of its text for a nested value."""
    total = F.lit(8).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _FIXED):
            size = F.lit(8)
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = F.lit(16) + F.coalesce(F.octet_length(c), F.lit(0))
        else:
            size = F.lit(16) + F.coalesce(F.octet_length(c.cast("string")), F.lit(0))
        total = total + size
    return total


def _size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes)."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return r["n"], r["b"] or 0


def _fits(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    n, size = _size(df)
    return n <= max_rows and size <= max_bytes


def _written(df: DataFrame) -> DataFrame:
    """``df`` in the shared folder, computed once; a column without a type becomes text."""
    return staged(df.withColumns({f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema.fields
                                  if isinstance(f.dataType, T.NullType)}), "lookup")


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES, written: bool = False) -> DataFrame:
    """Write the (usually aggregated) side once, measure its rows and bytes there, and
    hint it for broadcast only if both are within bounds; otherwise it is joined by
    shuffle (sort-merge, AQE skew split).  ``written``: it is a table already."""
    df = df if written else _written(df)
    return F.broadcast(df) if _fits(df, max_rows, max_bytes) else df


def key_filter(keys: DataFrame, on: str) -> DataFrame:
    """(page, bits): a bitmap of the keys' hashes, 4 KB a page."""
    at = F.pmod(F.xxhash64(on), F.lit(FILTER_BITS))
    return (keys.where(F.col(on).isNotNull()).select(at.alias("at"))
            .groupBy((F.col("at") / PAGE_BITS).cast("int").alias("__page"))
            .agg(F.bitmap_construct_agg((F.col("at") % PAGE_BITS).cast("int")).alias("__bits")))


def may_match(rows: DataFrame, pages: DataFrame, on: str) -> DataFrame:
    """``rows`` with ``__maybe``: false where the key is surely none of the filter's."""
    at = F.pmod(F.xxhash64(on), F.lit(FILTER_BITS))
    bit = (at % PAGE_BITS).cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    tagged = rows.withColumn("__page", (at / PAGE_BITS).cast("int")).join(F.broadcast(pages), "__page", "left")  # at most 4,096 pages
    return tagged.withColumn("__maybe", F.coalesce(F.getbit(byte.cast("long"), bit % 8) == 1, F.lit(False))).drop("__page", "__bits")


def hot_keys(rows: DataFrame, on: str) -> list:
    """Keys that may hold HOT_SHARE of the rows or more (2 / HOT_SHARE of them at most)."""
    found = rows.select(F.col(on).alias("k")).freqItems(["k"], HOT_SHARE).first()[0] or []
    return [k for k in found if k is not None]


def dealt_join(left: DataFrame, right: DataFrame, on: str, how: str) -> DataFrame:
    """Shuffle join in which a hot key's rows are dealt over HOT_PARTS tasks (equal rows to one)."""
    hot = hot_keys(left, on)
    if not hot:
        return left.join(right, on, how)
    is_hot = F.col(on).isin(hot)
    parts = F.when(is_hot, F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0)))
    # by the row's content alone: a task that runs again deals its rows the same way
    content = [F.col(f"`{f.name}`") for f in left.schema.fields if "map<" not in f.dataType.simpleString()]  # maps have no hash
    dealt = F.when(is_hot, F.pmod(F.xxhash64(*content), F.lit(HOT_PARTS))).otherwise(F.lit(0))
    return (left.withColumn("__part", dealt.cast("int"))
            .join(right.withColumn("__part", F.explode(parts)), [on, "__part"], how).drop("__part"))


def sized_join(left: DataFrame, right: DataFrame, on: str, how: str = "left",
               max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES, written: bool = False) -> DataFrame:
    """Lookup join of a (usually aggregated) ``right`` side on one key; ``written``: it is a
    table already.

    Small right side (rows and bytes measured): broadcast hash join,
    no shuffle of ``left``.  Otherwise a shuffle join of the rows that may match (see
    above); a row whose key is NULL (the classic hot key) or surely not in the table
    gets what its join type gives a row without a match: it is dropped (inner), kept
    (left anti), or NULL-extended (left)."""
    right = right if written else _written(right)
    n, size = _size(right)
    if n <= max_rows and size <= max_bytes:
        return left.join(F.broadcast(right), on, how)
    if how not in ("inner", "left", "left_outer", "left_anti"):
        return left.join(right, on, how)
    keyed, sure = left.where(F.col(on).isNotNull()), left.where(F.col(on).isNull())
    rows = keyed.count()
    if rows < LEAST_ROWS or rows * LEAST_ROW_BYTES < size:  # too few to filter, or the lookup side is the one that costs
        joined = keyed.join(right, on, how)
    else:
        joined, sure = _filtered_join(left, keyed, sure, right, n, on, how)
    if how == "inner":
        return joined
    if how == "left_anti":
        return joined.unionByName(sure)
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != on]
    return joined.unionByName(sure.select("*", *extra))


def _filtered_join(left: DataFrame, keyed: DataFrame, sure: DataFrame, right: DataFrame, n: int, on: str, how: str) -> tuple[DataFrame, DataFrame]:
    """(joined rows that may match, rows that surely do not)."""
    kind = left.schema[on].dataType
    # a hash filter needs one type on both sides; floating zeros have two forms
    kind = left.schema[on].dataType
    plain = kind == right.schema[on].dataType and not isinstance(kind, (T.FloatType, T.DoubleType, T.NullType))
    if plain and n <= FILTER_SHARE * FILTER_BITS:
        tagged = may_match(left, staged(key_filter(right, on), "key_filter"), on)
        keyed, sure = tagged.where("__maybe").drop("__maybe"), tagged.where("NOT __maybe").drop("__maybe")
    columns = left.columns if how == "left_anti" else dict.fromkeys([*left.columns, *right.columns])
    return dealt_join(keyed, right, on, how).select(*[F.col(f"`{c}`") for c in columns]), sure


def join_aggregate_back(detail: DataFrame, agg: DataFrame, on: str, how: str = "left",
                        max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Join a grouped aggregate back to the detail rows."""
    return sized_join(detail, agg, on, how, max_rows)


def id_to_name(df: DataFrame, id_col: str, new_col: str, names: list[str]) -> DataFrame:
    """Map the distinct ids, in sorted order, to supplied names.

    The distinct ids are counted first; more ids than names is an error (Q7), so
    the ranking window only ever sees at most ``len(names)`` rows (a bound held
    on the driver) and the lookup is broadcast.  NULL ids map to NULL."""
    spark = df.sparkSession
    ids = df.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    ids = staged(ids, "ids")
    n_ids = ids.count()
    if n_ids > len(names):
        raise ValueError(f"{n_ids} distinct ids but only {len(names)} names")
    ranked = ids.select(id_col, (F.row_number().over(Window.orderBy(id_col)) - 1).alias("__pos"))
    names_df = spark.createDataFrame(list(enumerate(names)), f"__pos int, {new_col} string")
    lookup = ranked.join(F.broadcast(names_df), "__pos").select(id_col, new_col)
    return df.join(F.broadcast(lookup), id_col, "left")
