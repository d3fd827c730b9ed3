"""The trie of conversations: one node for each distinct sequence of first turns.

A conversation is its path: 16 bytes of each turn's SHA-256, in the order of its turns,
so that equal beginnings are equal bytes and texts are read once only (``paths``).

Paths (ties: conversation ids) are range-partitioned by sampled splitters.  A node whose
members lie in several shards is a beginning of the splitter between them; the trie of
the splitters' paths, the skeleton, is broadcast, so each task knows these nodes by
number.  All other nodes lie in one shard, where the sorted rows finish them with a
stack of the nodes that are open; a second pass, from the last row back, gives each
its parent's smallest member.  Of skeleton nodes a shard only emits partial aggregates,
which are reduced by node, and then along the skeleton to what lies under them.  A
conversation with any number of copies is spread over shards by its copies' ids.

Bounds: ``SAMPLED`` conversations a shard, of which at most ``SPLITTER_TURNS`` first turns
are compared, make the skeleton; deeper nodes cannot lie in two shards, as rows equal in
these turns are on the same side of a splitter.  A task holds the nodes open at one row,
that is one conversation's path.  The ids that end at a skeleton node are hashed as a
stream in the order of shards.

Cases: turns are ordered by turn, null first, equal ones by role and then the text's hash;
null roles and texts are empty ones; a conversation without turns is a member of the root;
rows without a conversation id belong to none and are left out; repeated turns are turns;
an empty table has no node; of the other columns none is read."""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.llm.staging import staged
from scorecraft.operators.joins import broadcast_if_small

MARK = 16  # bytes of a turn's hash
SAMPLED, SPLITTER_TURNS = 8, 64
_CHUNK, _ROWS = 1 << 16, 20_000  # bytes of ids and rows emitted at once
_LOCAL, _PART, _ENDS = 0, 1, 2


def paths(conversations: DataFrame, id_col: str = "conv_id", order_col: str = "turn",
          role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, path, sizes): each conversation's turns as hashes and UTF-8 bytes of texts."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    mark = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * MARK))
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.struct(F.col(order_col).alias("turn"), role.alias("role"), mark.alias("mark"), F.octet_length(text).cast("long").alias("size")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return whole.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["mark"])), "")).alias("path"),
                        F.transform("t", lambda x: x["size"]).alias("sizes"))


def head(path, sizes, turns):
    """The first ``turns`` turns of (path, sizes)."""
    return F.substring(path, F.lit(1), turns * MARK), F.slice(sizes, F.lit(1), turns)


def tail(path, sizes, turns):
    """What follows them."""
    rest = F.greatest(F.size(sizes) - turns, F.lit(0))
    return F.substring(path, turns * MARK + 1, rest * MARK), F.slice(sizes, turns + 1, rest)


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with in common."""
    n, d = min(len(a), len(b)), 0
    if a[:n] == b[:n]:
        return n // MARK
    while a[d:d + MARK] == b[d:d + MARK]:
        d += MARK
    return d // MARK


class Skeleton:
    """The trie of sorted splitters; node 0 is the root."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = sorted(splitters)
        self.parent, self.depth, self.children = [-1], [0], [0]
        self.ids: list[np.ndarray] = []  # of each splitter's beginnings, by depth
        last, path = [0], b""
        for at, _ in self.splitters:
            own = last[:_common(path, at) + 1]
            while len(own) <= len(at) // MARK:
                self.children[own[-1]] += 1
                self.parent.append(own[-1])
                self.depth.append(len(own))
                self.children.append(0)
                own = [*own, len(self.parent) - 1]
            self.ids.append(np.array(own, np.int64))
            last, path = own, at

    def shard(self, path: bytes, conv: int) -> int:
        return bisect_right(self.splitters, (path, conv))

    def known(self, shard: int, path: bytes) -> np.ndarray:
        """Numbers of the beginnings of a path in this shard that are skeleton nodes, by depth."""
        best = np.zeros(1, np.int64)
        for k in (shard - 1, shard):
            if 0 <= k < len(self.splitters):
                d = _common(self.splitters[k][0], path)
                if d >= len(best):
                    best = self.ids[k][:d + 1]
        return best

    def line(self, node: int) -> list[int]:
        """A node and what is above it."""
        out = []
        while node >= 0:
            out.append(node)
            node = self.parent[node]
        return out


def _sample(rows: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """Splitters: evenly spaced among about SAMPLED times ``shards`` conversations, chosen by a hash."""
    share = min(1.0, SAMPLED * shards / max(rows.count(), 1))
    some = rows.where(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 31)) < int(share * (1 << 31)))
    cut = F.substring("path", 1, SPLITTER_TURNS * MARK)
    found = sorted((bytes(r[0]), r[1]) for r in some.select(cut, "conv_id").collect())
    return [found[k * len(found) // shards] for k in range(1, shards)] if len(found) >= shards else found


_EMITTED = ("shard int, seq long, kind int, node long, parent long, depth int, conv_id long, n_convs long, n_children long, "
            "n_leaves long, saved long, size long, ends binary, parent_conv_id long")
_NAMES = [c.split()[0] for c in _EMITTED.split(", ")]
_TYPES = [{"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in _EMITTED.split(", ")]


class _Node:
    __slots__ = ("skeleton", "least", "convs", "children", "leaves", "saved", "size", "ends", "sha")

    def __init__(self, skeleton, size: int):
        self.skeleton, self.size = skeleton, size
        self.least = None
        self.convs = self.children = self.leaves = self.saved = 0
        self.ends: list[bytes] = []
        self.sha = None

    def join(self, least: int, convs: int) -> None:
        self.least = least if self.least is None or least < self.least else self.least
        self.convs += convs


class _Scan:
    """The nodes of sorted rows, shard by shard."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton, self.shard, self.seq = skeleton, None, 0
        self.open: list[_Node] = []
        self.path = b""
        self.out: list[tuple] = []

    def emit(self, kind, node, parent, depth, *rest):
        self.out.append((self.shard, self.seq, kind, node, parent, depth, *rest, None))
        self.seq += 1

    def flush_ends(self, depth: int, x: _Node) -> None:
        if x.ends:
            self.emit(_ENDS, x.skeleton, None, depth, None, None, None, None, None, None, b",".join(x.ends))
            x.ends = []

    def close(self, depth: int) -> None:
        """Finish open nodes until ``depth`` of them are left."""
        while len(self.open) > depth:
            x, d = self.open.pop(), len(self.open)
            up = self.open[-1] if self.open else None
            if x.skeleton is not None:
                self.flush_ends(d, x)
                self.emit(_PART, x.skeleton, None, d, x.least, x.convs, x.children, x.leaves, x.saved, x.size, None)
            else:
                x.leaves = x.leaves or 1
                x.saved += (x.convs - 1) * x.size
                ends = (x.sha or hashlib.sha256()).hexdigest().encode()
                self.emit(_LOCAL, None, up.skeleton, d, x.least, x.convs, x.children, x.leaves, x.saved, x.size, ends)
                up.children += 1
            if up is not None:
                up.join(x.least, x.convs)
                up.leaves += x.leaves
                up.saved += x.saved

    def add(self, shard: int, path: bytes, conv: int, sizes) -> None:
        if shard != self.shard:
            self.close(0)
            self.shard, self.seq, self.path = shard, 0, b""
            self.open = [_Node(0, 0)]
        if path != self.path or len(self.open) == 1:
            same = _common(path, self.path)
            self.close(same + 1)
            if len(path) > same * MARK:
                known = self.skeleton.known(shard, path)
                for d in range(same + 1, len(path) // MARK + 1):
                    self.open.append(_Node(int(known[d]) if d < len(known) else None, sizes[d - 1].as_py()))
            self.path = path
        x = self.open[-1]
        x.join(conv, 1)
        if x.skeleton is None:
            if x.sha is None:
                x.sha = hashlib.sha256(b"%d" % conv)
            else:
                x.sha.update(b",%d" % conv)
        else:
            x.ends.append(b"%d" % conv)
            if len(x.ends) > _CHUNK // 16:
                self.flush_ends(len(self.open) - 1, x)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)


def _parents(batches):
    """Rows from the last one back: a node's parent is the last one seen a turn above."""
    shard, least = None, {}
    for batch in batches:
        get = [batch.column(k).to_pylist() for k in (0, 2, 4, 5, 6)]
        found = []
        for s, kind, parent, depth, conv in zip(*get):
            if s != shard:
                shard, least = s, {}
            if kind == _LOCAL:
                found.append(least.get(depth - 1) if parent is None else None)
                least[depth] = conv
            else:
                found.append(None)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], _NAMES)


def _streamed(batches):
    """SHA-256 of each node's ids, whose rows follow each other in order."""
    node, sha, out = None, None, []
    for batch in batches:
        for n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if n != node:
                if node is not None:
                    out.append((node, sha.hexdigest()))
                node, sha = n, hashlib.sha256(ids)
            else:
                sha.update(b",")
                sha.update(ids)
        if len(out) > _ROWS:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out]) for k in (0, 1)], ["node", "ends_sha256"])
            out = []
    if node is not None:
        out.append((node, sha.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out]) for k in (0, 1)], ["node", "ends_sha256"])


def prefix_trie(rows: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per node of the trie of ``paths`` rows (one a conversation): conv_id (the smallest
    member), depth, parent_conv_id (its parent's; the root's is null), n_convs, n_children,
    n_leaves (nodes without children in its subtree, itself included), saved_tokens (over its
    subtree, bytes of the last text for each member but one), ends_sha256 (of the ids of
    members that end here, ascending, joined by commas)."""
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = staged(rows.select("conv_id", "path", "sizes"), "paths")
    shared = spark.sparkContext.broadcast(Skeleton(_sample(rows, shards or 2 * partitions)))

    def deal(batches):
        skeleton = shared.value
        for batch in batches:
            where = [skeleton.shard(p, c) for c, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(where, pa.int32())], ["conv_id", "path", "sizes", "shard"])

    def scan(batches):
        state = _Scan(shared.value)
        for batch in batches:
            for shard, path, conv, sizes in zip(batch.column(3).to_pylist(), batch.column(1).to_pylist(), batch.column(0).to_pylist(), batch.column(2)):
                state.add(shard, path, conv, sizes)
                if len(state.out) >= _ROWS:
                    yield _batch(state.out)
                    state.out = []
        state.close(0)
        if state.out:
            yield _batch(state.out)

    dealt = rows.mapInArrow(deal, "conv_id long, path binary, sizes array<long>, shard int")
    nodes = dealt.repartition("shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(scan, _EMITTED)
    nodes = staged(nodes.sortWithinPartitions("shard", F.desc("seq")).mapInArrow(_parents, _EMITTED), "nodes")

    def upwards(batches):
        skeleton = shared.value
        for batch in batches:
            found = []
            for node, convs, children, size in zip(*(batch.column(k).to_pylist() for k in range(4))):
                leaf = int(children + skeleton.children[node] == 0)
                found += [(at, leaf, (convs - 1) * size) for at in skeleton.line(node)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(3)], ["node", "leaves", "saved"])

    def placed(batches):
        skeleton = shared.value
        for batch in batches:
            at = batch.column(0).to_pylist()
            parents = [skeleton.parent[n] for n in at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([None if p < 0 else p for p in parents], pa.int64()), pa.array([skeleton.children[n] for n in at], pa.int64())],
                ["node", "parent", "under"])

    parts = staged(nodes.where(f"kind = {_PART}").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("size").alias("size")), "skeleton")
    under = (parts.select("node", "n_convs", "n_children", "size").mapInArrow(upwards, "node long, leaves long, saved long")
             .groupBy("node").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
    ends = (nodes.where(f"kind = {_ENDS}").select("node", "shard", "seq", "ends").repartition("node").sortWithinPartitions("node", "shard", "seq")
            .select("node", "ends").mapInArrow(_streamed, "node long, ends_sha256 string"))
    up = parts.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_least"))
    skeleton = (parts.join(parts.select("node").mapInArrow(placed, "node long, parent long, under long"), "node")
                .join(under, "node").join(ends, "node", "left").join(up, "parent", "left")
                .select("conv_id", "depth", F.col("parent_least").alias("parent_conv_id"), "n_convs", (F.col("n_children") + F.col("under")).alias("n_children"),
                        (F.col("n_leaves") + F.col("more_leaves")).alias("n_leaves"), (F.col("saved") + F.col("more_saved")).alias("saved_tokens"),
                        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
    local = nodes.where(f"kind = {_LOCAL}").join(broadcast_if_small(up, written=True), "parent", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "parent_least").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("ends").cast("string").alias("ends_sha256"))
    return local.unionByName(skeleton).withColumn("depth", F.col("depth").cast("long"))
