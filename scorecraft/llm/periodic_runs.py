"""Periodic runs of words: where a text repeats a stretch of words again and again.

A run is a longest stretch of words in which words ``q`` apart are equal, ``q`` its
smallest period.  Every run is found from its Lyndon roots, under one of two opposite
orders of the words: a stretch that is the longest Lyndon word beginning at its place
and as long as the period.

Both Lyndon arrays come from phase one of Baier's suffix sorter.  It keeps suffixes in
groups that share a beginning (the group's context), at first their first word, and
takes the groups from the highest down.  Each suffix of the group taken has a last
suffix before it in a lower group; the context of that one grows by the group's, once
for every suffix that leads to it, and it moves to a group of its own behind its old
one.  When a group is taken its context is the longest Lyndon word at each of its
places, so that equal Lyndon words are equal groups.

Roots of one group that follow each other belong to one run; the run reaches as far as
the words a period apart go on to be equal, to both sides (longest common extensions).

A run of exponent e holds each of its words e times at least, so a word that a stretch
holds less often separates it; stretches are cut at such words until none is left, and
only what remains is sorted.  No run is lost: none holds a separator.

Cases: null, empty and blank texts have no words and no runs; each row is taken by
itself, so repeated rows and ids do not matter; long texts take longer by their length;
an empty table gives an empty result; of the other columns none is read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.llm.batches import binary_array, expand, steps, text_buffer

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def lyndon_groups(word: list[int]) -> tuple[list[int], list[int]]:
    """(length of the longest Lyndon word at each place, group of each place): equal
    groups are equal Lyndon words.  ``word`` holds ranks; a text's end is lower than all."""
    n = len(word)
    by_rank = sorted(range(n), key=word.__getitem__)  # places, group by group
    at, group = [0] * n, [0] * n
    size, context = [0] * n, [1] * n  # of the group that begins at an index of by_rank
    begin = 0
    for k, i in enumerate(by_rank):
        if word[i] != word[by_rank[begin]]:
            begin = k
        at[i], group[i] = k, begin
        size[begin] += 1
    before = [-1] * n
    end = n
    while end > 0:
        g = group[by_rank[end - 1]]
        grow = context[g]
        hits: dict[int, int] = {}
        for i in sorted(by_rank[g:end]) if end - g > 1 else (by_rank[g],):
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = before[j]
            before[i] = j
            if j >= 0:
                hits[j] = hits.get(j, 0) + 1
        by_times: dict[int, list[int]] = {}
        for j, times in hits.items():
            by_times.setdefault(times, []).append(j)
        for times in sorted(by_times, reverse=True):
            moved: dict[int, list[int]] = {}
            for j in by_times[times]:
                moved.setdefault(group[j], []).append(j)
            for h, places in moved.items():
                m, more = len(places), times * grow
                if m == size[h]:
                    context[h] += more
                    continue
                last = h + size[h]
                size[h] -= m
                new = last - m
                size[new], context[new] = m, context[h] + more
                for k, j in enumerate(places, 1):
                    a, other = at[j], by_rank[last - k]
                    by_rank[a], by_rank[last - k] = other, j
                    at[other], at[j] = a, last - k
                for j in places:
                    group[j] = new
        end = g
    return [context[g] for g in group], group


def _reach(a: np.ndarray, i: int, j: int) -> int:
    """Length of the common beginning of ``a[i:]`` and ``a[j:]``, i < j."""
    done, width = 0, 16
    while j + done < len(a):
        differ = np.flatnonzero(a[i + done:i + done + width][:len(a) - j - done] != a[j + done:j + done + width])
        if len(differ):
            return done + int(differ[0])
        done, width = min(done + width, len(a) - j), 2 * width
    return done


def runs_of(word: np.ndarray, least: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least ``least`` words and ``exponent``
    (2 or more) periods, in that order."""
    rank = np.unique(word, return_inverse=True)[1]
    found = set()
    back = word[::-1]
    for order in (rank, rank.max(initial=0) - rank):
        length, group = map(np.array, lyndon_groups(order.tolist()))
        place = np.arange(len(word))
        after = place + length
        inside = after < len(word)
        same = np.zeros(len(word), bool)  # an equal root follows
        same[inside] = group[after[inside]] == group[inside]
        follows = np.zeros(len(word), bool)
        follows[after[same]] = True
        # a run of e periods holds e - 1 whole roots at least
        for i in np.flatnonzero(~follows & same if exponent > 2 else ~follows):
            p, k = int(length[i]), int(i)
            while same[k]:
                k += p
            roots = (k - i) // p + 1
            if roots < exponent - 1:
                continue
            start = int(i) - _reach(back, len(word) - int(i) - p, len(word) - int(i))
            end = int(i) + p + _reach(word, int(i), int(i) + p)
            if end - start >= max(least, exponent * p):
                found.add((start, end - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(word: np.ndarray, begin: np.ndarray, exponent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of what is left of the stretches that begin at ``begin`` and cover ``word``
    when words that occur less than ``exponent`` times in their stretch have cut it, again
    and again; pieces under ``least`` words go."""
    part = np.zeros(len(word), np.int64)
    part[begin] = 1
    part = np.cumsum(part)
    place = np.arange(len(word))
    while len(place):
        key = part * (int(word.max()) + 1) + word[place]
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(key)))
        stay = np.empty(len(key), bool)
        stay[order] = np.repeat(count >= exponent, count)
        # a stretch ends where places or stretches do not go on
        left = place[stay]
        own = part[stay]
        if not len(left):
            break
        cut = np.concatenate([[True], (left[1:] != left[:-1] + 1) | (own[1:] != own[:-1])])
        size = np.diff(np.append(np.flatnonzero(cut), len(left)))
        long = np.repeat(size >= least, size)
        fresh = np.cumsum(cut)[long]
        if len(fresh) == len(place):
            break
        place, part = left[long], fresh
    if not len(place):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.concatenate([[True], part[1:] != part[:-1]])
    first = np.flatnonzero(cut)
    return place[first], place[np.append(first[1:], len(place)) - 1] + 1


def words_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte of each word, its end, number of the first word of each text and of the end)."""
    gap = np.ones(len(buf) + 1, bool)
    gap[:-1] = _SPACE[buf]
    start = ~gap[:-1]
    inner = np.zeros(len(buf) + 1, bool)
    inner[off] = True  # texts are apart
    start[1:] &= gap[:-2] | inner[1:-1]
    first = np.flatnonzero(start)
    stop = np.flatnonzero(~gap[:-1] & (gap[1:] | inner[1:])) + 1
    return first, stop, np.searchsorted(first, off)


def _step(buf: np.ndarray, off: np.ndarray, least: int, exponent: int):
    """For each text its runs and the places of the words that stay, as flat arrays."""
    first, stop, of_text = words_of(buf, off)
    size = stop - first
    joined = np.concatenate([[0], np.cumsum(size)])
    letters = buf[expand(first, size)]
    code = binary_array(joined, letters).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    runs: list[tuple[int, int, int]] = []
    counts = np.zeros(len(off) - 1, np.int64)
    stay = np.ones(len(code), bool)
    begin = of_text[:-1][of_text[:-1] < of_text[1:]]
    for lo, hi in zip(*stretches(code, begin, exponent, least)):
        text = int(np.searchsorted(of_text, lo, side="right")) - 1
        here = runs_of(code[lo:hi], least, exponent)
        for s, n, p in here:
            runs.append((int(lo) + s - int(of_text[text]), n, p))
            stay[lo + s + p:lo + s + n] = False
        counts[text] += len(here)
    return runs, counts, stay, joined, letters, of_text


def periodic_runs(docs: DataFrame, least: int = 6, exponent: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, ``n_words``, ``runs`` (array of start, length and
    period in words, by start and then period; runs of at least ``least`` words and
    ``exponent`` periods) and ``collapsed``, the words that no run holds after its first
    period, joined by one blank."""
    if exponent < 2 or least < 2:
        raise ValueError("runs have two periods and two words at least")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in steps(batches, "__text"):
            buf, off = text_buffer(batch.column(1))
            runs, counts, stay, joined, letters, of_text = _step(buf, off, least, exponent)
            kept = np.flatnonzero(stay)
            size = np.diff(joined)[kept] + 1  # with the blank behind
            ends = np.cumsum(size)
            data = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
            data[expand(ends - size, size - 1)] = letters[expand(joined[kept], size - 1)]
            texts = np.concatenate([[0], ends])[np.searchsorted(kept, of_text)]
            raw = data.tobytes()
            flat = np.array(runs, np.int64).reshape(-1, 3)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(of_text)), lists,
                 pa.array([raw[a:max(a, b - 1)].decode() for a, b in zip(texts, texts[1:])], pa.string())],
                ["__id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    out = rows.mapInArrow(run, f"__id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return out.withColumnRenamed("__id", id_col)
