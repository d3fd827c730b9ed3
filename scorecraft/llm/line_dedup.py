"""Line dedup: repeated passages of whole lines, or content-defined chunks of lines.

``passage_dedup`` (the query's) compares every run of ``min_lines`` consecutive lines,
a window, and every line of more than ``min_words`` words, a paragraph, with all others, without
the line ends.
Lines of windows and paragraphs that stand at an earlier (id, place) are removed, after
their bytes were compared; a longer passage is the union of its windows, so it goes whole
wherever it stands.  First only hashes are written, a narrow row per line; texts are
cut again for those whose hash repeats.

``line_dedup`` is the cheaper method that misses the ends of passages.  A text's lines (cut at line feeds, which stay with their line) are hashed, and a
rolling hash over the last ``window`` line hashes chooses boundaries: a chunk of at
least ``min_lines`` lines ends after a line where it is 0 modulo ``spread``.  Boundaries
depend on nearby lines only, so a passage that is inserted elsewhere is cut the same
way again, but for its ends.  A line of more than ``min_words`` words, a paragraph, is
a chunk of its own.  Chunks of at least ``min_lines`` lines and such paragraphs that
occur again anywhere are removed after their bytes were compared; the occurrence with
the smallest (id, place) stays.

Its chunks are written once to the shared checkpoint folder; counting reads only their
hashes.  Occurrences are counted before the shuffle, and only texts whose hash repeats
are compared, as grouping keys.  Decisions are narrow rows
per document, joined back to the documents; a very common passage is a skewed join
key, which adaptive execution splits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.llm.batches import binary_array, steps, text_buffer
from scorecraft.llm.staging import staged
from scorecraft.operators.joins import sized_join

_FACTOR = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True


def _words(buf: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Words that begin between each start and the next."""
    word = ~_BLANK[buf]
    word[1:] &= _BLANK[buf[:-1]]
    word[start] = ~_BLANK[buf[start]]
    return np.add.reduceat(word, start, dtype=np.int64) if len(start) else np.zeros(0, np.int64)


def _lines(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start byte of every line of a batch of texts; an empty text has none."""
    head = np.zeros(len(buf), bool)
    head[1:] = buf[:-1] == 0x0A
    head[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(head)


def chunk_spans(buf: np.ndarray, offsets: np.ndarray, window: int, spread: int, min_lines: int, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte of every chunk, its number of lines, first chunk of every text) of a
    batch of texts; an empty text has no chunk."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    line = _lines(buf, offsets)
    raw = buf.tobytes()
    h = np.fromiter((xxhash.xxh64_intdigest(raw[a:b]) for a, b in zip(line.tolist(), [*line[1:].tolist(), n])), np.uint64, len(line))
    opens = first[line]
    place = np.arange(len(line)) - np.maximum.accumulate(np.where(opens, np.arange(len(line)), 0))
    rolling = h.copy()
    for k in range(1, window):
        back = np.zeros_like(h)
        back[k:] = h[:-k]
        rolling = rolling * _FACTOR + np.where(place >= k, back, 0)
    ends = ((rolling * _MIX >> np.uint64(33)) % np.uint64(spread) == 0).tolist()
    long = (_words(buf, line) > min_words).tolist()
    starts, have = [], 0
    for k, new in enumerate(opens.tolist()):
        if new or long[k] or have < 0:
            starts.append(k)
            have = 0
        have += 1
        if long[k] or ends[k] and have >= min_lines:
            have = -1
    chunk = np.array(starts)
    return line[chunk], np.diff(np.append(chunk, len(line))), np.searchsorted(line[chunk], offsets)


def _hashes(buf: np.ndarray, start: np.ndarray) -> np.ndarray:
    raw = buf.tobytes()
    return np.fromiter((xxhash.xxh64_intdigest(raw[a:b]) for a, b in zip(start.tolist(), [*start[1:].tolist(), len(buf)])), np.uint64, len(start)).view(np.int64)


def line_dedup(docs: DataFrame, window: int = 2, spread: int = 2, min_lines: int = 2, min_words: int = 50,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, text_col (what is left of it), n_chunks and
    n_removed.

    Cases: null text counts as empty and has no chunks; a text without line feeds is
    one line; a chunk that repeats within one text is removed there too; rows that
    repeat an id are one document to the decisions (the same chunk at the same place
    stays or goes in all of them); a null id keeps its text and counts nowhere; an empty
    table gives an empty result; other columns are not read, whatever their names."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def chunks(batches):
        for batch in steps(batches, "text"):
            buf, off = text_buffer(batch.column(1))
            start, lines, edge = chunk_spans(buf, off, window, spread, min_lines, min_words)
            size = np.diff(np.append(start, len(buf)))
            words = _words(buf, start)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(edge))
            use = np.flatnonzero((lines >= min_lines) | (words > min_words))
            text = binary_array(np.append(start, len(buf)), buf).take(pa.array(use)).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc[use])), pa.array((np.arange(len(start)) - edge[doc])[use].astype(np.int32)),
                 pa.array(_hashes(buf, start)[use]), pa.array(size[use].astype(np.int32)), text], ["id", "no", "h", "size", "chunk"])

    found = staged(rows.where("id is not null").mapInArrow(chunks, f"id {id_type}, no int, h long, size int, chunk binary"), "line_chunks")
    again = staged(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "line_hashes")
    maybe = staged(sized_join(found, again, "h", "inner"), "line_candidates")
    # equal bytes, not only equal hashes
    keep = staged(maybe.groupBy("h", "chunk").agg(F.min(F.struct("id", "no")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "line_repeats")
    gone = maybe.join(keep, ["h", "chunk"]).where(F.struct("id", "no") != F.col("first"))
    lists = staged(gone.groupBy("id").agg(F.collect_set(F.struct("no", "h")).alias("gone")), "line_removals")  # at most a text's chunks

    def cut(batches):
        for batch in steps(batches, "text"):
            buf, off = text_buffer(batch.column(1))
            start, _, edge = chunk_spans(buf, off, window, spread, min_lines, min_words)
            drop = np.zeros(len(start), bool)
            lists = batch.column(2)
            for k in np.flatnonzero(~lists.is_null().to_numpy(zero_copy_only=False)):
                items = lists[int(k)].as_py()
                at = np.array([x["no"] for x in items]) + edge[k]
                fits = at < edge[k + 1]
                want = np.array([x["h"] for x in items])[fits]
                at = at[fits]
                hashes = np.array([xxhash.xxh64_intdigest(buf[start[c]:start[c + 1] if c + 1 < len(start) else len(buf)].tobytes()) for c in at], np.uint64).view(np.int64)
                drop[at[hashes == want]] = True
            size = np.diff(np.append(start, len(buf)))
            left = np.repeat(~drop, size)
            kept = np.concatenate([[0], np.cumsum(np.where(drop, 0, size))])[edge]
            text = pa.Array.from_buffers(pa.large_string(), batch.num_rows, [None, pa.py_buffer(kept.astype(np.int64)), pa.py_buffer(buf[left])])
            count = np.concatenate([[0], np.cumsum(drop)])[edge]
            yield pa.RecordBatch.from_arrays([batch.column(0), text.cast(pa.string()), pa.array(np.diff(edge)), pa.array(np.diff(count))],
                                             ["id", "text", "n_chunks", "n_removed"])

    joined = sized_join(rows, lists, "id", "left").select("id", "text", "gone")
    out = joined.mapInArrow(cut, f"id {id_type}, text string, n_chunks long, n_removed long")
    return out.withColumnsRenamed({"id": id_col, "text": text_col})


class _Units:
    """Windows and paragraphs of a batch of texts, by the line they begin with."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, min_lines: int, min_words: int):
        self.raw, self.min_lines = buf.tobytes(), min_lines
        self.start = _lines(buf, offsets)
        self.edge = np.searchsorted(self.start, offsets)  # first line of every text
        n = len(self.start)
        self.size = np.diff(np.append(self.start, len(buf)))
        self.stop = self.start + self.size  # less the line's terminator
        for byte in (0x0A, 0x0D):
            self.stop -= (self.stop > self.start) & (buf[self.stop - 1] == byte)
        h = np.fromiter((xxhash.xxh64_intdigest(self.raw[a:b]) for a, b in zip(self.start.tolist(), self.stop.tolist())), np.uint64, n)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.edge))
        self.window = np.arange(n) + min_lines <= self.edge[self.doc + 1]
        self.paragraph = _words(buf, self.start) > min_words
        rolling = h.copy()
        for k in range(1, min_lines):
            ahead = np.zeros_like(h)
            ahead[:-k] = h[k:]
            rolling = rolling * _FACTOR + ahead
        self.window_hash, self.paragraph_hash = (rolling * _MIX).view(np.int64), h.view(np.int64)

    def found(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first line, hash, number of lines) of the units that ``lists`` (a list of
        (no, h) or null per text) name and that are there."""
        doc = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        items = lists.flatten()
        no, h = (items.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        line = self.edge[doc] + no
        there = line < self.edge[doc + 1]
        line, h = line[there], h[there]
        window = self.window[line] & (self.window_hash[line] == h)
        use = window | self.paragraph[line] & (self.paragraph_hash[line] == h)
        return line[use], h[use], np.where(window, self.min_lines, 1)[use]

    def text(self, line: int, lines: int) -> bytes:
        return b"\n".join(self.raw[self.start[k]:self.stop[k]] for k in range(line, line + lines))


def passage_dedup(docs: DataFrame, min_lines: int = 2, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, text_col (what is left of it), n_chunks (its
    lines) and n_removed (lines removed).

    A line goes if it belongs to ``min_lines`` consecutive lines, or has more than
    ``min_words`` words, that stand at a smaller (id, place) too; windows that overlap
    their first place in the same text stay.  The first place of every line stays.
    Lines are compared without the line feed, or carriage return and line feed, that
    ends them, and keep it in what is left.

    Cases: null text counts as empty and has no lines; a text without line feeds is
    one line; a passage that repeats within one text is removed there too; rows that
    repeat an id are one document to the decisions (the same lines at the same place
    stay or go in all of them); a null id keeps its text and counts nowhere; an empty
    table gives an empty result; other columns are not read, whatever their names."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def hashes(batches):
        for batch in steps(batches, "text"):
            u = _Units(*text_buffer(batch.column(1)), min_lines, min_words)
            for use, h in ((u.window, u.window_hash), (u.paragraph, u.paragraph_hash)):
                at = np.flatnonzero(use)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(u.doc[at])), pa.array((at - u.edge[u.doc[at]]).astype(np.int32)), pa.array(h[at])],
                                                 ["id", "no", "h"])

    def texts(batches):
        for batch in steps(batches, "text"):
            u = _Units(*text_buffer(batch.column(1)), min_lines, min_words)
            at, h, lines = u.found(batch.column(2))
            for lo in range(0, len(at), 1 << 14):
                k = slice(lo, lo + (1 << 14))
                chunk = pa.array([u.text(a, n) for a, n in zip(at[k].tolist(), lines[k].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(u.doc[at[k]])), pa.array((at - u.edge[u.doc[at]])[k].astype(np.int32)),
                                                  pa.array(lines[k].astype(np.int32)), pa.array(h[k]), chunk], ["id", "no", "lines", "h", "chunk"])

    def per_text(units, name):  # at most a text's lines, twice
        return staged(units.groupBy("id").agg(F.collect_set(F.struct("no", "h")).alias("units")), name)

    found = staged(rows.where("id is not null").mapInArrow(hashes, f"id {id_type}, no int, h long"), "line_windows")
    again = staged(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "line_hashes")
    maybe = per_text(sized_join(found, again, "h", "inner"), "line_maybe")
    candidates = sized_join(rows, maybe, "id", "inner").select("id", "text", "units")
    candidates = staged(candidates.mapInArrow(texts, f"id {id_type}, no int, lines int, h long, chunk binary"), "line_candidates")
    # equal bytes, not only equal hashes
    keep = staged(candidates.groupBy("h", "lines", "chunk").agg(F.min(F.struct("id", "no")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "line_repeats")
    apart = (F.col("id") != F.col("first.id")) | (F.col("first.no") + F.col("lines") <= F.col("no"))
    lists = per_text(candidates.join(keep, ["h", "lines", "chunk"]).where(apart), "line_removals")

    def cut(batches):
        for batch in steps(batches, "text"):
            buf, off = text_buffer(batch.column(1))
            u = _Units(buf, off, min_lines, min_words)
            at, _, lines = u.found(batch.column(2))
            cover = np.zeros(len(u.start) + 1, np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + lines, -1)
            drop = np.cumsum(cover)[:-1] > 0
            kept = np.concatenate([[0], np.cumsum(np.where(drop, 0, u.size))])[u.edge]
            left = buf[np.repeat(~drop, u.size)]
            text = pa.Array.from_buffers(pa.large_string(), batch.num_rows, [None, pa.py_buffer(kept.astype(np.int64)), pa.py_buffer(left)])
            count = np.concatenate([[0], np.cumsum(drop)])[u.edge]
            yield pa.RecordBatch.from_arrays([batch.column(0), text.cast(pa.string()), pa.array(np.diff(u.edge)), pa.array(np.diff(count))],
                                             ["id", "text", "n_chunks", "n_removed"])

    out = sized_join(rows, lists, "id", "left").select("id", "text", "units").mapInArrow(cut, f"id {id_type}, text string, n_chunks long, n_removed long")
    return out.withColumnsRenamed({"id": id_col, "text": text_col})
