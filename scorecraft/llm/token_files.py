"""Token ids as binary files.

Format of a file: blocks, each followed by one newline byte.  A block is
    magic ``TKB1``, then four unsigned 64-bit little-endian numbers: block number,
    documents, ids, data bytes; the documents' ids (signed 64-bit) and a byte per
    document that is 1 where the id is null; the documents' numbers of ids
    (unsigned 32-bit); control bytes, four ids each, two bits an id (its length
    less one, lowest bits first); data bytes (little-endian, 1 to 4 an id).
What is stored is not the id but its rank by frequency over the whole corpus, so
frequent ids take one byte.  ``ranks`` lists the ids by rank, ``index`` the blocks
in ascending order of document id with the number of ids before each.

Writing takes two passes over the encoded corpus: one counts ids, one writes.
Documents ascend within a block, and blocks do not overlap; where the input is
not in that order already, its encoded rows are range-partitioned by document id
first.  The second pass writes blocks in that order, file after file by name.  Files are written by Spark's committer into the given folder, so a lost
executor leaves no half file, and are read back as whole binary files.

Cases: null text is empty, so its document has the end id alone; null document
ids come first; repeated ids stay, in any order among themselves; an empty table
gives files without blocks; only the id and text columns are read."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorecraft.llm.batches import STEP_BYTES, expand, steps, text_buffer
from scorecraft.llm.library import library, read_spec, texts_of
from scorecraft.llm.pretokens import distinct
from scorecraft.operators.joins import sized_join
from scorecraft.session import scratch_path

MAGIC = b"TKB1"
# Blocks in one file (a block holds the ids of about 8 MB of text).
BLOCKS_PER_FILE = 4
_LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
_STAGED = "block long, ids array<long>, sizes array<int>, tokens binary"


# -- the coding ---------------------------------------------------------------
def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = values.astype("<u4")
    size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    code = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    code[:len(v)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]].tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n values of ``pack``: lengths by table lookup on the control bytes."""
    size = _LENGTHS[control].reshape(-1)[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    out = data[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_block(number: int, ids: pa.Array, sizes: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    return b"".join([MAGIC, struct.pack("<4Q", number, len(ids), len(ranks), len(data)),
                     ids.fill_null(0).to_numpy().astype("<i8").tobytes(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                     sizes.astype("<u4").tobytes(), control, data])


def read_blocks(content: bytes):
    """(block number, document ids, their numbers of ids, ranks) of each block of a file."""
    at = 0
    while at < len(content):
        if content[at:at + 4] != MAGIC:
            raise ValueError("not a block of token ids")
        number, n_docs, n, n_data = struct.unpack_from("<4Q", content, at + 4)
        at += 36
        ids = np.frombuffer(content, "<i8", n_docs, at)
        null = np.frombuffer(content, np.uint8, n_docs, at + 8 * n_docs).astype(bool)
        sizes = np.frombuffer(content, "<u4", n_docs, at + 9 * n_docs)
        at += 13 * n_docs
        n_control = -(-n // 4)
        ranks = unpack(np.frombuffer(content, np.uint8, n_control, at), np.frombuffer(content, np.uint8, n_data, at + n_control), n)
        at += n_control + n_data + 1
        yield number, pa.array(ids, pa.int64(), mask=null), sizes.astype(np.int64), ranks


# -- the jobs -----------------------------------------------------------------
def _staged_batch(block: int, ids: pa.Array, sizes: np.ndarray, tokens: np.ndarray) -> pa.RecordBatch:
    raw = tokens.astype(np.uint16 if not len(tokens) or tokens.max() < 1 << 16 else np.uint32)
    one = pa.array([0, len(ids)], pa.int32())
    packed = bytes([raw.itemsize]) + pa.compress(raw.tobytes(), codec="zstd", asbytes=True)
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.ListArray.from_arrays(one, ids.cast(pa.int64())),
                                       pa.ListArray.from_arrays(one, pa.array(sizes, pa.int32())), pa.array([packed], pa.binary())],
                                      ["block", "ids", "sizes", "tokens"])


def _tokens(cell: pa.Scalar, n: int) -> np.ndarray:
    raw = cell.as_buffer()
    width = memoryview(raw).cast("B")[0]
    return np.frombuffer(pa.decompress(raw.slice(1), n * width, codec="zstd"), np.uint16 if width == 2 else np.uint32)


def _encode(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def run(batches):
        lib = library(shared)
        part, step = TaskContext.get().partitionId(), 0
        for batch in steps(batches, "__text", 2 * STEP_BYTES):
            buf, off = text_buffer(batch.column(1))
            starts, whole = lib.cut(buf, off)
            codes, pieces = distinct(buf, starts)
            flat, count = lib.of_pieces(pieces)
            edge = np.searchsorted(starts, off)
            n_ids = count[codes]
            ends = np.concatenate([[0], np.cumsum(n_ids)])[edge]
            flat = flat[expand((np.cumsum(count) - count)[codes], n_ids)]
            own = {k: np.array(lib.ids(text), np.int32) for k, text in texts_of(buf, off, whole)}
            order = pc.sort_indices(batch.column(0), null_placement="at_start").to_numpy()
            doc = [own[k] if k in own else flat[ends[k]:ends[k + 1]] for k in order.tolist()]
            sizes = np.array([len(x) + 1 for x in doc], np.int64)
            tokens = np.full(int(sizes.sum()), end_id, np.int32)
            kept = np.ones(len(tokens), bool)
            kept[np.cumsum(sizes) - 1] = False
            tokens[kept] = np.concatenate(doc)
            yield _staged_batch(part << 32 | step, batch.column(0).take(pa.array(order)), sizes, tokens)
            step += 1

    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    return rows.mapInArrow(run, _STAGED)


def _in_order(spark: SparkSession, staged: DataFrame) -> DataFrame:
    """Blocks that do not overlap: those given, or the documents partitioned by range."""
    edge = staged.select(F.coalesce(F.col("ids")[0], F.lit(-2**63)).alias("lo"), F.coalesce(F.element_at("ids", -1), F.lit(-2**63)).alias("hi"))
    w = Window.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)  # one narrow row per block
    if not edge.withColumn("before", F.max("hi").over(w)).where("before > lo").head(1):
        return staged

    def apart(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ids, sizes = batch.column(1).slice(k, 1).flatten(), batch.column(2).slice(k, 1).flatten().to_numpy()
                tokens = _tokens(batch.column(3)[k], int(sizes.sum())).astype("<u4")
                cuts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64) * 4
                data = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(cuts), pa.py_buffer(tokens)])
                yield pa.RecordBatch.from_arrays([ids, data.cast(pa.binary())], ["id", "tokens"])

    def together(batches):
        part, step = TaskContext.get().partitionId(), 0
        for batch in steps(batches, "tokens"):
            buf, off = text_buffer(batch.column(1))
            yield _staged_batch(part << 32 | step, batch.column(0), np.diff(off) // 4, np.frombuffer(buf.tobytes(), "<u4"))
            step += 1

    path = scratch_path(spark, "token_rows")
    (staged.mapInArrow(apart, "id long, tokens binary").repartitionByRange(F.col("id").asc_nulls_first())
     .sortWithinPartitions(F.col("id").asc_nulls_first()).mapInArrow(together, _STAGED).write.option("compression", "uncompressed").parquet(path))
    return spark.read.schema(_STAGED).parquet(path)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text with the tokenizers library (no special tokens added),
    append ``end_id``, and write ``folder``/blocks, /ranks and /index."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token_blocks")
    _encode(docs, tokenizer, end_id, id_col, text_col).write.option("compression", "uncompressed").parquet(path)
    staged = _in_order(spark, spark.read.schema(_STAGED).parquet(path))

    def frequencies(batches):
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                n = np.bincount(_tokens(batch.column(1)[k], int(batch.column(0).slice(k, 1).flatten().to_numpy().sum())))
                if len(n) > len(total):
                    total = np.concatenate([total, np.zeros(len(n) - len(total), np.int64)])
                total[:len(n)] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    # at most one row per id of the vocabulary
    n = staged.select("sizes", "tokens").mapInArrow(frequencies, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ranked = [r.id for r in n.orderBy(F.desc("n"), "id").collect()]
    spark.createDataFrame(list(enumerate(ranked)), "rank long, id long").write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(max(ranked, default=0) + 1, np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)

    def write(batches):
        rank_of = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                ids, sizes = batch.column(1).slice(k, 1).flatten(), batch.column(2).slice(k, 1).flatten().to_numpy()
                tokens = _tokens(batch.column(3)[k], int(sizes.sum()))
                yield pa.RecordBatch.from_arrays([pa.array([write_block(batch.column(0)[k].as_py(), ids, sizes, rank_of[tokens])], pa.binary())], ["block"])

    sizes = staged.select("block", F.coalesce(F.col("ids")[0], F.lit(-2**63)).alias("first"),
                          F.coalesce(F.element_at("ids", -1), F.lit(-2**63)).alias("last"), F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    w = Window.orderBy("first", "last", "block")  # one narrow row per block of 8 MB of text
    sizes.select("block", (F.row_number().over(w) - 1).alias("position"),
                 (F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("start"), "n").write.parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index").select("block", "position")
    # files and the blocks in them follow each other in the order of the ids
    ordered = sized_join(staged, index, "block", "inner", written=True).repartitionByRange("position").sortWithinPartitions("position")
    # a text file's line is written byte for byte: a block and its newline
    (ordered.select(*staged.columns).mapInArrow(write, "block binary").select(F.col("block").cast("string"))
     .write.option("maxRecordsPerFile", BLOCKS_PER_FILE).text(f"{folder}/blocks"))


def read_token_files(spark: SparkSession, folder: str, digest=None, digest_type: str = "array<long>") -> DataFrame:
    """One row per document of the files: doc_id, start (ids before it), n_tokens
    and ``tokens``: its ids, or what the function ``digest`` makes of them (it gets
    a document's ids as a numpy array of unsigned 32-bit numbers)."""
    ranked = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()  # at most the vocabulary
    shared = spark.sparkContext.broadcast(np.array([r.id for r in ranked], "<u4"))

    def run(batches):
        id_of = shared.value
        for batch in batches:
            for content in batch.column(0):
                for number, ids, sizes, ranks in read_blocks(content.as_py()):
                    ends = np.concatenate([[0], np.cumsum(sizes)])
                    tokens = id_of[ranks]
                    if digest is None:
                        out = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens, pa.int64()))
                    else:
                        out = pa.array([digest(tokens[a:b]) for a, b in zip(ends[:-1], ends[1:])])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), number), pa.int64()), ids, pa.array(ends[:-1], pa.int64()),
                                                      pa.array(sizes, pa.int64()), out], ["block", "doc_id", "__at", "n_tokens", "tokens"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/blocks").select("content")
    rows = files.mapInArrow(run, f"block long, doc_id long, __at long, n_tokens long, tokens {digest_type}")
    index = spark.read.parquet(f"{folder}/index").select("block", "start")
    return rows.join(index, "block").select("doc_id", (F.col("start") + F.col("__at")).alias("start"), "n_tokens", "tokens")
