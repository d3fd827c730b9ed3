"""SimHash near-duplicates: fingerprints, and all links within a few bits.

Fingerprint: words are split at blanks, lower-cased (A-Z), and joined to shingles;
a bit is 1 where more than half of the shingles' XXH64 values have it.

Search among distinct fingerprints by vantage-point trees.  Two fingerprints that
differ in at most ``max_bits`` bits agree up to one bit in at least one of
``max_bits // 2 + 1`` parts of the 64 bits, so there is one tree per part, searched
with radius 1.  Each level of a tree has a vantage point; a node's children are the
rings of equal Hamming distance from it, and the path of rings is a leaf shard.
Triangle bounds prune: a neighbour at distance 0 lies in the same rings, one at
distance 1 lies exactly one ring further in or out at every level.  Every
fingerprint is stored in its own shard and queries that shard and, one way, those
across the ring boundaries.  All 64 bits decide in the shard.

The number of levels grows with the number of fingerprints.  A shard with many
members (texts that are all alike) is split into tiles of members and queries,
whose number follows from the shard's count.  A tile returns links that connect
what it found, not all pairs, and holds its members only; queries stream past."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecraft.llm.batches import steps, text_buffer
from scorecraft.llm.components import components
from scorecraft.llm.staging import staged
from scorecraft.operators.joins import sized_join

# Members that a tile aims at, and the branching that one level of rings gives.
TILE, BRANCHING = 1024, 11
BLOCK = 1 << 16  # shingles hashed at a time
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BLANK = np.zeros(256, bool)
_BLANK[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True


def shingle_spans(buf: np.ndarray, offsets: np.ndarray, size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(normalised bytes, starts, ends, number per text) of the shingles of texts."""
    word = ~_BLANK[buf]
    first = word.copy()
    first[1:] &= ~word[:-1]
    edge = offsets[:-1][offsets[:-1] < len(buf)]
    first[edge] = word[edge]
    at = np.flatnonzero(first)
    last = word.copy()
    last[:-1] &= ~word[1:] | first[1:]
    length = np.flatnonzero(last) + 1 - at
    n_words = np.diff(np.searchsorted(at, offsets))
    # words one after the other with a space behind each
    begin = np.cumsum(length + 1) - (length + 1)
    joined = np.full(int((length + 1).sum()), 0x20, np.uint8)
    where = np.flatnonzero(word)
    joined[where - np.repeat(at, length) + np.repeat(begin, length)] = _LOWER[buf[where]]
    n = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    lo = np.cumsum(n_words) - n_words
    i = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    j = i + np.repeat(np.minimum(size, n_words) - 1, n)
    return joined.tobytes(), begin[i], begin[j] + length[j], n


def fingerprints(buf: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """Unsigned 64-bit fingerprints of texts; 0 for a text without words."""
    raw, lo, hi, n = shingle_spans(buf, offsets, size)
    digest = xxhash.xxh64_intdigest
    count = np.zeros((len(n), 64), np.int64)
    text = np.repeat(np.arange(len(n)), n)
    for a in range(0, len(lo), BLOCK):  # so that a long text needs no more room than short ones
        b = min(len(lo), a + BLOCK)
        h = np.fromiter((digest(raw[x:y], 42) for x, y in zip(lo[a:b].tolist(), hi[a:b].tolist())), np.uint64, b - a)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.diff(text[a:b], prepend=-1))
        count[text[a:b][first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    return np.packbits(2 * count > n[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprint(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text", keep: tuple | list = ()) -> DataFrame:
    """(id, fp, the columns ``keep``): the fingerprint of every row as a signed 64-bit number."""
    id_type = docs.schema[id_col].dataType.simpleString()
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        for batch in steps(batches, "text", 1 << 20):
            buf, off = text_buffer(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(buf, off, size).view(np.int64)), *batch.columns[2:]], ["id", "fp", *keep])

    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *keep).mapInArrow(run, f"id {id_type}, fp long{more}")


def _rings(fp: Column, part: int, parts: int, levels: int) -> list[Column]:
    """Hamming distances from the vantage points of one tree."""
    draw = random.Random(part)
    lo, hi = 64 * part // parts, 64 * (part + 1) // parts
    mask = (1 << hi) - (1 << lo)
    points = [draw.getrandbits(64) & mask for _ in range(levels)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    own = fp.bitwiseAND(F.lit(signed(mask)))
    return [F.bit_count(own.bitwiseXOR(F.lit(signed(p)))) for p in points]


def _shard(part: int, rings: list[Column]) -> Column:
    key = F.lit(part).cast("long")
    for r in rings:
        key = key * 67 + r + 1
    return key


def _linked(members: np.ndarray, reps: np.ndarray, label: np.ndarray, fp: np.ndarray, rep: np.ndarray, bits: int) -> list[tuple]:
    """Links that connect a batch of queries with the members they match; label
    holds each member's smallest representative so far and is brought up to date."""
    edges = []
    room = max(1, (1 << 21) // max(1, len(members)))
    for lo in range(0, len(fp), room):
        q, r = fp[lo:lo + room], rep[lo:lo + room]
        i, j = np.nonzero(np.bitwise_count(q[:, None] ^ members[None, :]) <= bits)
        other = r[i] != reps[j]
        i, j = i[other], j[other]
        if not len(i):
            continue
        old, mine = label.copy(), r.copy()
        while True:  # smallest representative over the matches, back and forth
            new = mine.copy()
            np.minimum.at(new, i, label[j])
            back = label.copy()
            np.minimum.at(back, j, new[i])
            if (new == mine).all() and (back == label).all():
                break
            mine = new
            label[:] = back
        moved = np.flatnonzero(mine != r)
        edges.append((r[moved], mine[moved]))
        moved = np.flatnonzero(label != old)
        edges.append((old[moved], label[moved]))
    return edges


def links(points: DataFrame, max_bits: int) -> DataFrame:
    """Edges (a, b) between representatives, which connect all ``points`` (fp, rep;
    each fp once) whose fingerprints differ in at most ``max_bits`` bits."""
    parts = max_bits // 2 + 1
    n = points.count()
    levels = max(1, math.ceil(math.log(max(n, 1) / 512 + 1, BRANCHING)))
    signs = [[1, *(1 if k >> b & 1 else -1 for b in range(levels - 1))] for k in range(1 << levels - 1)]
    homes, visits = [], []
    for part in range(parts):
        rings = _rings(F.col("fp"), part, parts, levels)
        homes.append(_shard(part, rings))
        visits += [_shard(part, rings)] + [_shard(part, [r + s for r, s in zip(rings, sign)]) for sign in signs]
    members = points.select("fp", "rep", F.explode(F.array(*homes)).alias("shard"))
    queries = points.select("fp", "rep", F.explode(F.array(*visits)).alias("shard"))
    count = staged(members.groupBy("shard").agg(F.ceil(F.count("*") / TILE).cast("int").alias("k")), "shards")
    members = sized_join(members, count, "shard", "inner")
    queries = sized_join(queries, count, "shard", "inner")  # shards without members go
    deal = lambda seed: F.pmod(F.xxhash64("fp", F.lit(seed)), F.col("k")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    tiles = (members.select("shard", deal(1).alias("x"), every.alias("y"), F.lit(0).alias("role"), "fp", "rep")
             .union(queries.select("shard", every.alias("x"), deal(2).alias("y"), F.lit(1).alias("role"), "fp", "rep")))

    def run(batches):
        tile, fps, reps, label = None, [], [], None
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
            role, fp, rep = (batch.column(k).to_numpy() for k in (3, 4, 5))
            fp = fp.view(np.uint64)
            new = np.flatnonzero((key[1:] != key[:-1]).any(1) | (role[1:] != role[:-1])) + 1
            for lo, hi in zip([0, *new], [*new, len(fp)]):
                if lo == hi:
                    continue
                if tile is None or (key[lo] != tile).any():
                    tile, fps, reps, label = key[lo], [], [], None
                if role[lo] == 0:
                    fps.append(fp[lo:hi])
                    reps.append(rep[lo:hi])
                    continue
                if not fps:
                    continue
                if label is None:
                    fps, reps = [np.concatenate(fps)], [np.concatenate(reps)]
                    label = reps[0].copy()
                for a, b in _linked(fps[0], reps[0], label, fp[lo:hi], rep[lo:hi], max_bits):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return (tiles.repartition("shard", "x", "y").sortWithinPartitions("shard", "x", "y", "role")
            .mapInArrow(run, "a long, b long"))


def simhash_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text", keep: tuple | list = ()) -> DataFrame:
    """One row per row of ``docs``: id_col (whole numbers), the columns ``keep`` (other than
    those of the result, id and fp), fingerprint (16 hex
    digits), component_id (the smallest id reachable over links of at most
    ``max_bits`` differing bits) and kept (the row has that id).

    Cases: null and blank texts have fingerprint zero and link like any other;
    fewer words than a shingle make one shingle; rows that repeat an id are kept or
    dropped together; a null id has a fingerprint, component_id null, kept true, and
    links nothing; an empty table gives an empty result; other columns are not read."""
    marks = staged(fingerprint(docs, shingle, id_col, text_col, keep).withColumn("id", F.col("id").cast("long")), "fingerprints")
    points = staged(marks.where("id is not null").groupBy("fp").agg(F.min("id").alias("rep")), "distinct_fingerprints")
    found = components(staged(links(points, max_bits), "links"))
    named = points.join(found, points["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    out = marks.join(named, "fp", "left")
    component = F.when(F.col("id").isNotNull(), F.col("component_id"))
    return out.select(F.col("id").alias(id_col), *keep, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
