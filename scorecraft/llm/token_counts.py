"""Token counts without token ids.

1. Every block of texts (a piece of an input partition) is cut into pre-tokens;
   each document's pre-token frequencies are kept as (number of the pre-token in
   the block, count), and the block's distinct pre-tokens go out in buckets by hash.
2. The buckets are shuffled, so that a pre-token meets itself from all blocks in
   one task; there the library counts its pieces once.
3. The counts go back to their blocks, are joined to the frequencies, and summed.

Frequencies travel as compressed arrays per block, not as a row per document and
pre-token: those rows would be several times the input.  A frequent pre-token is
one entry per block, so none is hot.  Blocks and buckets are written once to the
shared checkpoint folder, which both later steps read.

Cases: null text counts as empty (0 bytes, 0 tokens); added strings inside a text
count as the library counts them by default; repeated rows and ids are counted
row by row; an empty table gives an empty result; only the id and text columns
are read, so others may have any name."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.llm.batches import STEP_BYTES, steps, text_buffer
from scorecraft.llm.library import library, read_spec, texts_of
from scorecraft.llm.pretokens import distinct
from scorecraft.session import scratch_path

# bucket null: a block's documents, with ``n`` entries (steps between pre-token numbers,
# frequencies) in data; else ``n`` pre-tokens numbered from ``lo`` (sizes, bytes)
_BLOCKS = "block long, bucket int, lo int, n int, ids array<{id}>, n_bytes array<long>, whole array<long>, ends array<long>, sizes binary, data binary"


def _pack(*arrays: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed with the bytes of equal weight side by side."""
    return pa.compress(b"".join(a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays), codec="zstd", asbytes=True)


def _unpack(cell: pa.Scalar, *sizes: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(cell.as_buffer(), 4 * sum(sizes), codec="zstd"), np.uint8)
    ends = np.cumsum([0, *sizes]) * 4
    return [np.ascontiguousarray(raw[a:b].reshape(4, -1).T).view("<u4").ravel() for a, b in zip(ends[:-1], ends[1:])]


def _bucket(pieces: pa.Array, n: int) -> np.ndarray:
    """A bucket for each pre-token, from its length and its first and last eight bytes."""
    buf, off = text_buffer(pieces)
    size = np.diff(off)
    h = size.astype(np.uint64)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    for k in range(8):
        for at in (off[:-1] + np.minimum(k, size - 1), off[1:] - 1 - np.minimum(k, size - 1)):
            h = (h ^ padded[at]) * np.uint64(0x100000001B3)
    return ((h >> np.uint64(20)) % np.uint64(n)).astype(np.int64)


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_bytes (UTF-8) and n_tokens, as the
    tokenizers library gives them for the file ``tokenizer`` (read on the driver
    and broadcast; its size is that of the vocabulary)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_spec(tokenizer))
    id_type = docs.schema[id_col].dataType.simpleString()
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = _BLOCKS.format(id=id_type)
    names = [x.split()[0] for x in schema.split(", ")]

    def blocks(batches):
        lib = library(shared)
        part, step = TaskContext.get().partitionId(), 0
        for batch in steps(batches, "__text", 4 * STEP_BYTES):
            block = part << 32 | step
            step += 1
            buf, off = text_buffer(batch.column(1))
            starts, whole = lib.cut(buf, off)
            own = np.zeros(batch.num_rows, np.int64)
            for k, text in texts_of(buf, off, whole):
                own[k] = len(lib.ids(text))
            codes, pieces = distinct(buf, starts)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(np.searchsorted(starts, off)))
            use = ~whole[doc]
            # number the pre-tokens that count by bucket, so that a bucket is a range of numbers
            seen = np.zeros(len(pieces), bool)
            seen[codes[use]] = True
            kept = np.flatnonzero(seen)
            bucket = _bucket(pieces, n_buckets)[kept]
            order = np.argsort(bucket, kind="stable")
            kept, bucket = kept[order], bucket[order]
            number = np.zeros(len(pieces), np.int64)
            number[kept] = np.arange(len(kept))
            # one key per document and pre-token; its run length is the frequency
            key, count = np.unique(doc[use] * max(len(kept), 1) + number[codes[use]], return_counts=True)
            doc, code = np.divmod(key, max(len(kept), 1))
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=batch.num_rows))])
            gap = np.diff(code, prepend=0)
            gap[ends[:-1][ends[:-1] < ends[1:]]] = code[ends[:-1][ends[:-1] < ends[1:]]]
            row = dict.fromkeys(names)
            row |= {"block": [block], "n": [len(code)], "ids": pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0)),
                    "n_bytes": [np.diff(off)], "whole": [own], "ends": [ends], "data": [_pack(gap, count)]}
            yield _batch(row, 1)
            cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            if len(bucket):
                raw, at = text_buffer(pieces.take(pa.array(kept)))
                row = dict.fromkeys(names)
                row |= {"block": np.full(len(cuts) - 1, block), "bucket": bucket[cuts[:-1]].astype(np.int32), "lo": cuts[:-1].astype(np.int32),
                        "n": np.diff(cuts).astype(np.int32), "sizes": [_pack(np.diff(at[a:b + 1])) for a, b in zip(cuts[:-1], cuts[1:])],
                        "data": [pa.compress(raw[at[a]:at[b]].tobytes(), codec="zstd", asbytes=True) for a, b in zip(cuts[:-1], cuts[1:])]}
                yield _batch(row, len(cuts) - 1)

    id_arrow = None

    def _batch(row: dict, n: int) -> pa.RecordBatch:
        nonlocal id_arrow
        if isinstance(row["ids"], pa.ListArray):
            id_arrow = row["ids"].type
        wide = pa.list_(pa.int64())
        types = {"block": pa.int64(), "bucket": pa.int32(), "lo": pa.int32(), "n": pa.int32(), "ids": id_arrow, "n_bytes": wide, "whole": wide,
                 "ends": wide, "sizes": pa.binary(), "data": pa.binary()}
        return pa.RecordBatch.from_arrays(
            [v if isinstance(v, pa.Array) else pa.nulls(n, types[k]) if v is None else pa.array(v, types[k]) for k, v in row.items()], list(row))

    def count(batches):
        lib = library(shared)
        known: dict[bytes, int] = {}  # of this task's buckets: no pre-token is in another task
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                size, = _unpack(batch.column(3)[k], batch.column(2)[k].as_py())
                cut = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
                data = pa.decompress(batch.column(4)[k].as_buffer(), int(cut[-1]), codec="zstd", asbytes=True)
                pieces = [data[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                new = [x for x in pieces if x not in known]
                known.update(zip(new, lib.count_pieces(new)))
                out.append(_pack(np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], ["block", "lo", "n", "counts"])

    def total(batches):
        for batch in batches:
            col = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            for k in range(batch.num_rows):
                get = lambda n: col[n].slice(k, 1).flatten()
                ids, n_bytes, own, ends = get("ids"), get("n_bytes"), get("whole").to_numpy(), get("ends").to_numpy()
                gap, freq = _unpack(col["data"][k], int(ends[-1]), int(ends[-1]))
                code = np.cumsum(gap, dtype=np.int64)
                full = ends[:-1][ends[:-1] < ends[1:]]  # numbers begin anew with every document
                code -= np.repeat(code[full] - gap[full], np.diff(np.append(full, len(code))))
                pieces = np.zeros(int(code.max(initial=0)) + 1, np.int64)
                for x in get("got").to_pylist():
                    pieces[x["lo"]:x["lo"] + x["n"]] = _unpack(pa.scalar(x["counts"], pa.binary()), x["n"])[0]
                sums = np.concatenate([[0], np.cumsum(pieces[code] * freq)])[ends]
                yield pa.RecordBatch.from_arrays([ids, n_bytes, pa.array(own + np.diff(sums), pa.int64())], ["__id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    path = scratch_path(spark, "token_counts")
    rows.mapInArrow(blocks, schema).write.option("compression", "zstd").parquet(path)
    staged = spark.read.schema(schema).parquet(path)
    counted = (staged.where("bucket is not null").select("block", "bucket", "lo", "n", "sizes", "data")
               .repartition(n_buckets, "bucket").select("block", "lo", "n", "sizes", "data")
               .mapInArrow(count, "block long, lo int, n int, counts binary"))
    back = counted.groupBy("block").agg(F.collect_list(F.struct("lo", "n", "counts")).alias("got"))  # at most a block's vocabulary
    texts = staged.where("bucket is null").select("block", "ids", "n_bytes", "whole", "ends", "data")
    joined = (texts.join(back, "block", "left")
              .withColumn("got", F.coalesce("got", F.array().cast("array<struct<lo:int,n:int,counts:binary>>"))))
    return joined.drop("block").mapInArrow(total, f"__id {id_type}, n_bytes long, n_tokens long").withColumnRenamed("__id", id_col)
