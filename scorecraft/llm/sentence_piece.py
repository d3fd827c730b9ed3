"""SentencePiece encoding and decoding (byte-pair pieces with byte fallback) by a model file.

Blanks become U+2581, one more of which is put before a text that is not empty.
Adjacent symbols whose text together is a piece merge, the best score first, the
leftmost of equals; a character that is no piece becomes its UTF-8 bytes.

Encoding runs in merge rounds over flat numpy arrays: the symbols of all words of a
step lie side by side; a round takes every word's lowest pair rank (a segmented
minimum), merges all its places at once from the left, compacts the arrays and looks
up the pairs that are new; words without a pair leave.  Words are cut where no piece
reaches across: before a run of blanks and between two characters that stand next to
each other in no piece.  Each distinct word of a step is encoded once.

Merging all places at once is merging one after the other unless a merge makes a pair
that ranks as low as its own.  Such words (long runs of blanks, in practice) are seen
in the round and finished place by place with a heap.

Cases: null text is the empty text, which has the begin and end ids only; repeated
rows and document ids are encoded row by row; long texts and words only take longer;
an empty table gives an empty result; of the other columns none is read, whatever its
name.  Ids that are null or an empty list decode to the empty text."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.llm.batches import expand, steps, text_buffer
from scorecraft.llm.pretokens import distinct

BLANK = 0x2581
_BLANK_BYTES = chr(BLANK).encode()
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # kinds of pieces in a model file
_NONE = np.int32(1 << 30)  # no pair
STEP_BYTES, STEP_IDS = 1 << 20, 1 << 18  # texts and ids that a task works on at once
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CHARS = np.int64(0x110000)


def _fields(raw: bytes):
    """(number, value) of a protocol buffer message."""
    def varint(at):
        value = shift = 0
        while True:
            value |= (raw[at] & 0x7F) << shift
            shift, at = shift + 7, at + 1
            if raw[at - 1] < 0x80:
                return value, at
    at = 0
    while at < len(raw):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = raw[at:at + size], at + size
        yield key >> 3, value


def read_model(path: str) -> dict:
    """Pieces (text, score, kind), begin, end and unknown surface of a model file, checked to
    be one whose rules are those of this module."""
    with open(path, "rb") as f:
        top = list(_fields(f.read()))
    pieces = []
    for number, value in top:
        if number == 1:
            piece = dict(_fields(value))
            pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0], piece.get(3, NORMAL)))
    trainer = {k: v for n, raw in top if n == 2 for k, v in _fields(raw)}
    normal = {k: v for n, raw in top if n == 3 for k, v in _fields(raw)}
    kinds = {k for _, _, k in pieces}
    if (trainer.get(3, 1) != 2 or not trainer.get(35) or normal.get(2) or not normal.get(3, 1) or normal.get(4, 1)
            or not normal.get(5, 1) or trainer.get(24) or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}):
        raise ValueError("a BPE model with byte fallback, identity normaliser and blank before the text is needed")
    names = [p for p, _, _ in pieces]
    return {"pieces": pieces, "begin": names.index(trainer.get(46, b"<s>").decode()), "end": names.index(trainer.get(47, b"</s>").decode()),
            "unknown": trainer.get(44, " ⁇ ".encode())}


class Table:
    """Places of int64 keys in open addressing: ``find`` gives each key's index or -1."""

    def __init__(self, keys: np.ndarray):
        self.bits = np.uint64(64 - max(4, int(np.ceil(np.log2(4 * max(len(keys), 1))))))
        self.mask = (1 << (64 - int(self.bits))) - 1
        self.key = np.full(self.mask + 1, -1, np.int64)
        self.at = np.full(self.mask + 1, -1, np.int64)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.key[slot] < 0
            self.key[slot[free]] = keys[todo[free]]  # of several, one stays
            self.at[slot[free]] = todo[free]
            left = self.at[slot] != todo
            slot, todo = (slot[left] + 1) & self.mask, todo[left]

    def _slot(self, keys):
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * _MIX) >> self.bits).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot, out = self._slot(keys), np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            seen = self.key[slot]
            hit = seen == keys[todo]
            out[todo[hit]] = self.at[slot[hit]]
            go = ~hit & (seen >= 0)
            slot, todo = (slot[go] + 1) & self.mask, todo[go]
        return out


class Model:
    """A worker's tables: symbols are piece ids, or, above them, characters that are no piece."""

    def __init__(self, spec: dict):
        pieces = spec["pieces"]
        self.size = len(pieces)
        self.begin, self.end = spec["begin"], spec["end"]
        words = {p: k for k, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.symbol = np.arange(_CHARS, dtype=np.int32) + np.int32(self.size)  # of a character
        for p, k in words.items():
            if len(p) == 1:
                self.symbol[ord(p)] = k
        rank = {s: r for r, s in enumerate(sorted({pieces[k][1] for k in words.values()}, reverse=True))}
        lefts, rights, made, nexts = [], [], [], set()
        of = lambda x: int(self.symbol[ord(x)]) if len(x) == 1 else words.get(x)
        for p, k in words.items():
            nexts.update(zip(p, p[1:]))
            for c in range(1, len(p)):
                a, b = of(p[:c]), of(p[c:])
                if a is not None and b is not None:
                    lefts.append(a)
                    rights.append(b)
                    made.append(k)
        self.pairs = Table(self._pair(np.array(lefts, np.int64), np.array(rights, np.int64)))
        self.made = np.array([*made, -1], np.int32)
        self.rank = np.array([*(rank[pieces[k][1]] for k in made), _NONE], np.int32)
        self.nexts = Table(np.array([ord(a) * int(_CHARS) + ord(b) for a, b in nexts], np.int64))
        self.blanks_lead = all(chr(BLANK) not in p.lstrip(chr(BLANK)) for p in words)
        self.byte = np.zeros(256, np.int32)
        for k, (p, _, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte[int(p[3:5], 16)] = k

    @staticmethod
    def _pair(a, b):
        return (a.astype(np.int64) << 22) | b

    def _look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Index of each pair's merge, -1 (whose rank is _NONE) without one."""
        return self.pairs.find(self._pair(a, b))

    def _one_by_one(self, symbols: list[int]) -> list[int]:
        """A word merged place by place."""
        n = len(symbols)
        sym, left, right = list(symbols), list(range(-1, n - 1)), [*range(1, n), -1]
        ranks, made = self.rank, self.made

        def offer(places):
            places = [i for i in places if i >= 0 and right[i] >= 0]
            for i, k in zip(places, self._look(np.array([sym[i] for i in places], np.int64), np.array([sym[right[i]] for i in places], np.int64))):
                if k >= 0:
                    heapq.heappush(heap, (int(ranks[k]), i, sym[i], sym[right[i]], int(made[k])))
        heap: list = []
        offer(range(n))
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = right[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j], right[i] = new, -1, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer((left[i], i))
        return [s for s in sym if s >= 0]

    def merge(self, sym: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols after all merges, number per word) of words that begin at ``first``."""
        words = len(first)
        size = np.diff(np.append(first, len(sym)))
        word = np.repeat(np.arange(words, dtype=np.int32), size)
        out: list[tuple[np.ndarray, np.ndarray]] = []  # (word, symbol) of what is finished
        found = np.full(len(sym), -1, np.int32)

        def renew(at):
            at = at[(at >= 0) & (at + 1 < len(sym))]
            at = at[word[at] == word[at + 1]]
            found[at] = self._look(sym[at], sym[at + 1])
        renew(np.arange(len(sym)))
        while len(sym):
            begins = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            rank = self.rank[found]
            low = np.minimum.reduceat(rank, begins)
            size = np.diff(np.append(begins, len(sym)))
            each = np.repeat(low, size)
            over = each >= _NONE
            if over.any():
                out.append((word[over], sym[over]))
                stay = ~over
                sym, word, found, rank, each = sym[stay], word[stay], found[stay], rank[stay], each[stay]
                if not len(sym):
                    break
            hit = rank == each
            # of a stretch of overlapping places every other one, from the left
            start = hit & ~np.concatenate([[False], hit[:-1] & (word[1:] == word[:-1])])
            k = np.arange(len(sym), dtype=np.int32)
            since = k - np.maximum.accumulate(np.where(start, k, 0))
            at = np.flatnonzero(hit & (since % 2 == 0))
            new = self.made[found[at]]
            # pairs that merging in turn would meet: with the merge on the left done, that on the right not yet
            near = np.flatnonzero((at[1:] == at[:-1] + 2) & (word[at[1:]] == word[at[:-1]]))
            early = near[self.rank[self._look(new[near], sym[at[near + 1]])] <= each[at[near]]]
            bad = np.zeros(words, bool)
            bad[word[at[early]]] = True
            before, of = sym, word
            sym = sym.copy()
            sym[at] = new
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            moved = (np.cumsum(keep) - 1)[at]
            sym, word, found, each = sym[keep], word[keep], found[keep], each[keep]
            found[moved] = -1
            near = np.zeros(len(sym) + 1, bool)
            near[moved] = near[moved - 1] = True  # the last stands for what is before the first
            again = np.flatnonzero(near[:-1])
            found[again[word[again] == word[np.minimum(again + 1, len(word) - 1)]]] = -1
            renew(again)
            many = np.bincount(of[at], minlength=words) > 1
            low_again = again[self.rank[found[again]] <= each[again]]
            bad[word[low_again]] = True
            bad &= many
            if bad.any():
                for w in np.flatnonzero(bad):
                    lo, hi = np.searchsorted(of, [w, w + 1])
                    done = np.array(self._one_by_one(before[lo:hi].tolist()), np.int32)
                    out.append((np.full(len(done), w, np.int32), done))
                stay = ~bad[word]
                sym, word, found = sym[stay], word[stay], found[stay]
        owner = np.concatenate([w for w, _ in out]) if out else np.zeros(0, np.int32)
        flat = np.concatenate([s for _, s in out]) if out else np.zeros(0, np.int32)
        order = np.argsort(owner, kind="stable")
        return flat[order], np.bincount(owner, minlength=words)

    def encode_words(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each) of distinct words, blanks as 0x20."""
        buf, off = text_buffer(pieces)
        chars = np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        lead = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
        first = lead[off[:-1]]  # of each word, in characters
        chars = np.where(chars == 0x20, BLANK, chars)
        cut = np.zeros(len(chars), bool)
        cut[first] = True
        inner = np.flatnonzero(~cut)
        cut[inner] = self.nexts.find(chars[inner - 1] * _CHARS + chars[inner]) < 0
        starts = np.flatnonzero(cut)
        flat, count = self.merge(self.symbol[chars], starts)
        per_word = np.add.reduceat(count, np.searchsorted(starts, first)) if len(first) else np.zeros(0, np.int64)
        return self._bytes(flat, per_word)

    def _bytes(self, flat: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece as the ids of their bytes."""
        odd = np.flatnonzero(flat >= self.size)
        if not len(odd):
            return flat, count
        raw = np.frombuffer((flat[odd] - np.int32(self.size)).astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        begins = np.flatnonzero((raw & 0xC0) != 0x80)
        size = np.ones(len(flat), np.int64)
        size[odd] = np.diff(np.append(begins, len(raw)))
        ends = np.cumsum(size)
        out = np.repeat(flat, size)
        out[expand(ends[odd] - size[odd], size[odd])] = self.byte[raw]
        owner = np.repeat(np.arange(len(count)), count)
        return out, np.bincount(owner, weights=size, minlength=len(count)).astype(np.int64)

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets of each text's ids) of a batch of texts, with begin and end ids."""
        full = np.flatnonzero(off[:-1] < off[1:])
        at = off[full]
        buf = np.insert(buf, at, 0x20)
        text = at + np.arange(len(full))  # where the texts that are not empty begin now
        start = np.zeros(len(buf), bool)
        if self.blanks_lead and len(buf):
            start[1:] = (buf[1:] == 0x20) & (buf[:-1] != 0x20)
            own = np.flatnonzero(buf == _BLANK_BYTES[0])  # a text's own U+2581 is a blank as well
            own = own[own + 3 < len(buf)]
            own = own[(buf[own + 1] == _BLANK_BYTES[1]) & (buf[own + 2] == _BLANK_BYTES[2])]
            start[own + 3] = False
        start[text] = True
        starts = np.flatnonzero(start)
        codes, pieces = distinct(buf, starts)
        ids, count = self.encode_words(pieces)
        size = count[codes]
        flat = ids[expand((np.cumsum(count) - count)[codes], size)]
        ends = np.concatenate([[0], np.cumsum(size)])
        n = np.zeros(len(off) - 1, np.int64)
        n[full] = np.diff(ends[np.append(np.searchsorted(starts, text), len(starts))])
        ends = np.concatenate([[0], np.cumsum(n + 2)])
        out = np.empty(int(ends[-1]), np.int32)
        out[ends[:-1]], out[ends[1:] - 1] = self.begin, self.end
        out[expand(ends[:-1] + 1, n)] = flat
        return out, ends


class Surfaces:
    """The texts of ids."""

    def __init__(self, spec: dict):
        pieces = spec["pieces"]
        self.kind = np.array([kind for _, _, kind in pieces], np.int8)
        self.text = pa.array([bytes([int(p[3:5], 16)]) if kind == BYTE else spec["unknown"] if kind == UNKNOWN else b"" if kind == CONTROL
                              else p.replace(chr(BLANK), " ").encode() for p, _, kind in pieces], pa.large_binary())
        self.leads = np.array([kind == NORMAL and p.startswith(chr(BLANK)) for p, _, kind in pieces])

    def decode(self, ids: np.ndarray, off: np.ndarray) -> list[str]:
        """The text of each list of ids."""
        raw, at = text_buffer(self.text.take(pa.array(ids)))
        kind = self.kind[ids]
        # the blank put before the text: that of the first id that is not a begin or end
        shown = np.flatnonzero(kind != CONTROL)
        k = np.searchsorted(shown, off[:-1])
        lead = np.full(len(off) - 1, -1, np.int64)
        some = k < len(shown)
        lead[some] = np.where(shown[k[some]] < off[1:][some], shown[k[some]], -1)
        skip = (lead >= 0) & self.leads[ids[lead]] if len(ids) else np.zeros(len(off) - 1, bool)
        is_byte = kind == BYTE
        # bytes apart by an id without text are no character together
        apart = np.zeros(len(off) - 1, np.int64)
        inside = np.flatnonzero((kind[1:-1] == CONTROL) & is_byte[:-2]) + 1
        np.add.at(apart, np.searchsorted(off, inside, side="right") - 1, 1)
        out = []
        for i in range(len(off) - 1):
            lo, hi = at[off[i]], at[off[i + 1]]
            data = raw[lo + int(skip[i]):hi].tobytes()
            if apart[i]:
                cuts = at[np.flatnonzero(kind[off[i]:off[i + 1]] == CONTROL) + off[i]] - lo
                cuts = [0, *np.maximum(cuts - int(skip[i]), 0), len(data)]
                out.append("".join(data[a:b].decode("utf-8", "each_byte") for a, b in zip(cuts, cuts[1:])))
            else:
                out.append(data.decode("utf-8", "each_byte"))
        return out


codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


@lru_cache(maxsize=2)
def load(path: str) -> dict:
    return read_model(path)


_LOADED: dict = {}  # of this worker: the last tables of each kind


def _tables(kind, shared):
    spec = shared.value
    if _LOADED.get(kind, (None,))[0] is not spec:
        _LOADED[kind] = spec, kind(spec)
    return _LOADED[kind][1]


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col and ``ids`` (array of int, with the begin and end
    ids).  ``model`` is the path of a model file, read on the driver and broadcast (its size
    is that of the vocabulary)."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        tables = _tables(Model, shared)
        for batch in steps(batches, "__text", STEP_BYTES):
            ids, ends = tables.encode(*text_buffer(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))], ["__id", "ids"])

    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    return rows.mapInArrow(run, f"__id {id_type}, ids array<int>").withColumnRenamed("__id", id_col)


def decode(rows: DataFrame, model: str, ids_col: str = "ids", to: str = "decoded", digest: str | None = None) -> DataFrame:
    """``rows`` with column ``to``: the text of the ids.  Begin and end ids have no text; a
    byte that is no part of a character is U+FFFD.  ``digest`` names a further column, the
    SHA-256 of the ids as little-endian numbers of 32 bits."""
    shared = rows.sparkSession.sparkContext.broadcast(load(model))
    keep = [c for c in rows.columns if c not in (ids_col, to, digest)]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (*keep, ids_col))
    made = [to, *([digest] if digest else [])]

    def run(batches):
        tables = _tables(Surfaces, shared)
        for batch in batches:
            lists = batch.column(len(keep))
            off = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
            values, lo = lists.values, 0
            while lo < batch.num_rows:  # some rows at a time
                hi = max(lo + 1, int(np.searchsorted(off, off[lo] + STEP_IDS, side="right")) - 1)
                at = off[lo:hi + 1] - off[lo]
                ids = values.slice(off[lo], int(at[-1])).to_numpy(zero_copy_only=False)
                new = [pa.array(tables.decode(ids, at), pa.string())]
                if digest:
                    raw = ids.astype("<u4")
                    new.append(pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at, at[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, *new], [*keep, ids_col, *made])
                lo = hi

    slim = rows.select(*keep, F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias(ids_col))
    return slim.mapInArrow(run, ", ".join([schema, *(f"`{c}` string" for c in made)]))
