"""Byte-level BPE encoding and decoding by a rank file.

Each match of the split pattern is encoded by itself: adjacent parts whose
concatenation has the lowest rank merge first, the leftmost of equals, until no
adjacent pair has a rank.  A segment tree over the byte positions of a pre-token
holds in every node the leftmost minimum pair rank below it; a merge reads the
root, and then sets three leaves (the merged part, its left neighbour and the
part that went) in O(log n).  Neighbours are linked lists over live positions.

Short pre-tokens run many trees at once, as numpy arrays with one row per
pre-token; longer ones run one tree each, so a text that is a single run of
100,000 letters costs n log n steps.  Each distinct pre-token of a batch is
encoded once.

Cases: null text is the empty text, which has no ids; pre-tokens that are in the
vocabulary as a whole are their id; repeated rows and repeated document ids are
encoded row by row; an empty table gives an empty result; other columns do not
matter, whatever their names: only the id and the text column are read."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.llm.batches import expand, steps, text_buffer
from scorecraft.llm.pretokens import boundaries, distinct

# Widths of the trees that run side by side; longer pre-tokens run alone.
WIDTHS = (2, 4, 8, 16, 32, 64)
_NONE = np.int64(1) << 40  # no pair
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_MIX = np.uint64(0x9E3779B97F4A7C15)
# White space as the pattern's library understands it (the regex module's differs).
_WHITE = r"\t-\r \x85\xa0  -     　"


def load_ranks(path: str) -> list[bytes]:
    """Tokens by rank of a rank file (lines of base64 token and rank); ranks must be 0, 1, ..."""
    found = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                found[int(rank)] = base64.b64decode(token)
    if sorted(found) != list(range(len(found))) or any(bytes([b]) not in set(found.values()) for b in range(256)):
        raise ValueError("ranks must be consecutive and cover every single byte")
    return [found[k] for k in range(len(found))]


class Vocabulary:
    """Rank lookups of pairs of ids as a hash table in numpy arrays."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {t: k for k, t in enumerate(tokens)}
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for k, t in enumerate(tokens):
            for cut in range(1, len(t)):
                a, b = self.rank.get(t[:cut]), self.rank.get(t[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = k
        self.pairs = pairs
        self.bits = max(4, (2 * len(pairs)).bit_length() + 1)
        self.shift = np.uint64(64 - self.bits)
        key = np.full(1 << self.bits, _EMPTY, np.uint64)
        val = np.full(1 << self.bits, _NONE, np.int64)
        mask = (1 << self.bits) - 1
        for k, v in pairs.items():
            at = (k * int(_MIX) & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
            while key[at] != _EMPTY:
                at = at + 1 & mask
            key[at], val[at] = k, v
        self.key, self.val = key, val

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the concatenation of each pair of ids, _NONE where it is no token."""
        want = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        at = (want * _MIX >> self.shift).astype(np.int64)
        found = self.key[at]
        out = self.val[at]
        open_ = np.flatnonzero((found != want) & (found != _EMPTY))
        while len(open_):
            at[open_] = at[open_] + 1 & (len(self.key) - 1)
            found = self.key[at[open_]]
            out[open_] = self.val[at[open_]]
            open_ = open_[(found != want[open_]) & (found != _EMPTY)]
        return out

    # -- one tree -----------------------------------------------------------
    def encode_long(self, piece: bytes) -> list[int]:
        """Ids of one pre-token with a tree of its own."""
        n = len(piece)
        width = 1 << max(0, n - 1).bit_length()
        none = int(_NONE) * width
        pairs = self.pairs
        ids = [int(self.byte_id[b]) for b in piece]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        tree = [none] * (2 * width)

        def value(i: int, j: int) -> int:
            r = pairs.get(ids[i] << 32 | ids[j]) if j < n else None
            return none if r is None else r * width + i

        for i in range(n):
            tree[width + i] = value(i, i + 1)
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(i: int, v: int) -> None:
            k = width + i
            tree[k] = v
            while k > 1:
                k >>= 1
                low = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == low:
                    break
                tree[k] = low

        while tree[1] < none:
            rank, i = divmod(tree[1], width)
            gone = right[i]
            ids[i] = rank
            right[i] = after = right[gone]
            if after < n:
                left[after] = i
            put(gone, none)
            put(i, value(i, after))
            if left[i] >= 0:
                put(left[i], value(left[i], i))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = right[i]
        return out

    # -- many trees side by side ----------------------------------------------
    def encode_rows(self, byte: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens given as rows of bytes (row width a power of two):
        all ids one after the other, and how many each row has."""
        m, width = byte.shape
        col = np.arange(width)
        live = col < length[:, None]
        ids = self.byte_id[byte].ravel()
        right = np.broadcast_to(col + 1, (m, width)).astype(np.int64).ravel()
        left = np.broadcast_to(col - 1, (m, width)).astype(np.int64).ravel()
        none = _NONE * width
        tree = np.full((m, 2 * width), none, np.int64)
        has = col[:-1] + 1 < length[:, None]
        r, c = np.nonzero(has)
        rank = self.pair_rank(ids[r * width + c], ids[r * width + c + 1])
        tree[r, width + c] = np.where(rank < _NONE, rank * width + c, none)
        for k in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])
        tree = tree.ravel()
        live = live.ravel()

        def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray | np.int64) -> None:
            base, node = rows * (2 * width), at + width
            tree[base + node] = value
            for _ in range(width.bit_length() - 1):
                node = node >> 1
                tree[base + node] = np.minimum(tree[base + 2 * node], tree[base + 2 * node + 1])

        def value(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
            out = np.full(len(rows), none, np.int64)
            ok = np.flatnonzero(j < length[rows])
            rank = self.pair_rank(ids[rows[ok] * width + i[ok]], ids[rows[ok] * width + j[ok]])
            out[ok] = np.where(rank < _NONE, rank * width + i[ok], none)
            return out

        rows = np.flatnonzero(tree[1::2 * width] < none)
        while len(rows):
            best = tree[rows * (2 * width) + 1]
            i = best & (width - 1)
            at = rows * width + i
            gone = right[at]
            after = right[rows * width + gone]
            ids[at] = best // width
            right[at] = after
            live[rows * width + gone] = False
            inner = after < length[rows]
            left[rows[inner] * width + after[inner]] = i[inner]
            put(rows, gone, none)
            put(rows, i, value(rows, i, after))
            before = left[at]
            has_left = before >= 0
            put(rows[has_left], before[has_left], value(rows[has_left], before[has_left], i[has_left]))
            rows = rows[tree[rows * (2 * width) + 1] < none]
        return ids[live], live.reshape(m, width).sum(1)

    def encode_distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each piece) for distinct pre-tokens."""
        buf, off = text_buffer(pieces)
        size = np.diff(off)
        n = len(size)
        count = np.zeros(n, np.int64)
        parts: dict[int, np.ndarray] = {}
        known = np.array([self.rank.get(x, -1) for x in pieces.to_pylist()], np.int64)
        whole = known >= 0
        count[whole] = 1
        found = [(np.flatnonzero(whole), known[whole])]
        low = 0
        for width in WIDTHS:
            pick = np.flatnonzero(~whole & (size > low) & (size <= width))
            low = width
            if len(pick):
                col = np.arange(width)
                at = np.minimum(off[pick][:, None] + col, max(len(buf) - 1, 0))
                ids, counts = self.encode_rows(np.where(col < size[pick][:, None], buf[at], 0), size[pick])
                count[pick] = counts
                found.append((pick, ids))
        for k in np.flatnonzero(~whole & (size > low)):
            parts[k] = np.array(self.encode_long(buf[off[k]:off[k + 1]].tobytes()), np.int64)
            count[k] = len(parts[k])
        begin = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int32)
        for pick, ids in found:
            out[expand(begin[pick], count[pick])] = ids
        for k, ids in parts.items():
            out[begin[k]:begin[k] + len(ids)] = ids
        return out, count


@lru_cache(maxsize=4)
def _splitter(pattern: str):
    return regex.compile(pattern.replace(r"[^\s", "[^" + _WHITE).replace(r"\S", f"[^{_WHITE}]").replace(r"\s", f"[{_WHITE}]"))


def cut(buf: np.ndarray, offsets: np.ndarray, pattern: str) -> np.ndarray:
    """Bytes at which the pre-tokens of the texts begin."""
    start, unknown = boundaries(buf, offsets)
    for k in np.flatnonzero(unknown):
        lo, hi = int(offsets[k]), int(offsets[k + 1])
        sizes = [len(x.encode()) for x in _splitter(pattern).findall(buf[lo:hi].tobytes().decode())]
        start[lo:hi] = False
        start[lo + np.cumsum([0, *sizes[:-1]])] = True
    return np.flatnonzero(start)


def encode_texts(vocabulary: Vocabulary, buf: np.ndarray, offsets: np.ndarray, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, offsets of each text's ids) of a batch of texts."""
    starts = cut(buf, offsets, pattern)
    codes, pieces = distinct(buf, starts)
    ids, count = vocabulary.encode_distinct(pieces)
    sizes = count[codes]
    flat = ids[expand((np.cumsum(count) - count)[codes], sizes)]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return flat, ends[np.searchsorted(starts, offsets)]


_LOADED: dict = {}  # of this worker: the last vocabulary


def _vocabulary(shared) -> Vocabulary:
    tokens = shared.value
    if _LOADED.get("tokens") is not tokens:
        _LOADED.update(tokens=tokens, vocabulary=Vocabulary(tokens))
    return _LOADED["vocabulary"]


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col and ``ids`` (array of int).  ``ranks``
    is the path of a rank file, read on the driver and broadcast (its size is that
    of the vocabulary); ``pattern`` splits the texts."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load_ranks(ranks))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        vocabulary = _vocabulary(shared)
        for batch in steps(batches, "__text"):
            buf, off = text_buffer(batch.column(1))
            ids, ends = encode_texts(vocabulary, buf, off, pattern)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))], ["__id", "ids"])

    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    return rows.mapInArrow(run, f"__id {id_type}, ids array<int>").withColumnRenamed("__id", id_col)


def decode(rows: DataFrame, ranks: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` with column ``to``: the bytes of the ids (binary; no ids or null: empty)."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(load_ranks(ranks))
    keep = [c for c in rows.columns if c not in (ids_col, to)]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (*keep, ids_col))

    def run(batches):
        tokens = pa.array(shared.value, pa.large_binary())
        for batch in batches:
            at = batch.schema.get_field_index(ids_col)
            lists = batch.column(at)
            off = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
            data = tokens.take(lists.values.slice(off[0], off[-1] - off[0]))
            raw, ends = text_buffer(data)
            text = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends[off - off[0]].copy()), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([*batch.columns, text.cast(pa.binary())], [*batch.schema.names, to])

    slim = rows.select(*keep, F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias(ids_col))
    return slim.mapInArrow(run, f"{schema}, `{to}` binary")
