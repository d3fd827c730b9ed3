"""Near-duplicate embeddings by a tiled comparison along principal axes.

Vectors are scaled to length one and rotated so that leading dimensions hold most
of the length (eigenvectors of the second-moment matrix, from one distributed
pass).  Copies of one vector are one representative.  Representatives are sorted
along the leading axis and cut into blocks; every pair of blocks whose stretches of that
axis come as near as linked vectors do is one group of a shuffle, in which tiles are compared: inner products are accumulated over leading
dimensions, what the rest can add is bounded by the product of the suffix norms,
and pairs (in the end whole tiles) that cannot reach the threshold are dropped
before the next dimensions.  A block pair whose tiles' balls around their centres
are too far apart is not compared at all.  Pairs left at the end are decided by the
unrotated vectors in double precision.

A block pair returns for each vector how many it links with, and links that connect
what it found (not all pairs), so a large group of near copies stays linear.  Where all
vectors lie within reach along the first axis, all pairs of blocks are met, which grows
with the square of the number of distinct vectors; this is what an exact answer without
candidates costs."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorecraft.llm.components import components
from scorecraft.llm.staging import staged

# Rows of a tile, dimensions added at a time, blocks at least, and vectors that a block
# aims at (of 64 dimensions; longer vectors make smaller blocks, down to a tile).
TILE, STEP, BLOCKS, BLOCK = 1024, 16, 8, 8192
# Rounding of rotated products; pairs this near the threshold are left to the exact test.
SLACK = 1e-9


def usable(vector) -> F.Column:
    """Not null, no null or non-finite component, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(lists: pa.Array, dim: int) -> np.ndarray:
    x = lists.flatten().to_numpy().astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow of squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _axes(points: DataFrame, dim: int) -> np.ndarray:
    """Eigenvectors of the second-moment matrix, largest eigenvalue first.  The sums
    are dim * dim numbers per task, added up by Spark."""
    def moments(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            x = _unit(batch.column(0), dim)
            total += x.T @ x
        i, j = np.divmod(np.arange(dim * dim), dim)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "s"])

    m = np.zeros((dim, dim))
    for r in points.select("v").mapInArrow(moments, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        m[r.i, r.j] = r.s
    return np.linalg.eigh((m + m.T) / 2)[1][:, ::-1].copy()


def _tile_pairs(a: np.ndarray, b: np.ndarray, ra: np.ndarray, rb: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two rotated tiles whose product may reach the threshold; ra and
    rb hold the norms of what follows each step's dimensions."""
    dim = a.shape[1]
    product = np.zeros((len(a), len(b)))
    done = 0
    for k in range(ra.shape[1]):
        hi = min(dim, done + STEP)
        product += a[:, done:hi] @ b[:, done:hi].T
        done = hi
        open_ = product + ra[:, k, None] * rb[None, :, k] >= threshold - SLACK
        left = int(np.count_nonzero(open_))
        if left == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if left * 16 < open_.size or done == dim:  # few are left: finish them one by one
            i, j = np.nonzero(open_)
            kept = product[i, j]
            while done < dim and len(i):
                hi = min(dim, done + STEP)
                kept = kept + np.einsum("ij,ij->i", a[i, done:hi], b[j, done:hi])
                k += 1
                done = hi
                ok = kept + ra[i, k] * rb[j, k] >= threshold - SLACK
                i, j, kept = i[ok], j[ok], kept[ok]
            return i, j
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def _block_pair(x: np.ndarray, y: np.ndarray, rep_x: np.ndarray, rep_y: np.ndarray, n_x: np.ndarray, n_y: np.ndarray,
                axes: np.ndarray, threshold: float, same: bool) -> tuple:
    """(links of x, links of y, edges) of two blocks of unit vectors."""
    def prepare(u):
        rotated = u @ axes
        squares = np.cumsum((rotated * rotated)[:, ::-1], axis=1)[:, ::-1]
        ends = [min(len(axes), k + STEP) for k in range(0, len(axes), STEP)]
        rest = np.sqrt(np.stack([squares[:, e] if e < len(axes) else np.zeros(len(u)) for e in ends], 1))
        tiles = [slice(k, k + TILE) for k in range(0, len(u), TILE)]
        centres = np.stack([rotated[t].mean(0) for t in tiles]) if tiles else np.zeros((0, len(axes)))
        radius = np.array([np.sqrt(((rotated[t] - c) ** 2).sum(1).max()) for t, c in zip(tiles, centres)])
        return rotated, rest, tiles, centres, radius

    (a, ra, ta, ca, da), (b, rb, tb, cb, db) = prepare(x), prepare(y)
    far = np.sqrt(2 - 2 * threshold) + SLACK  # distance of unit vectors at the threshold
    links_x, links_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    label = {}

    def root(k):
        while label.setdefault(k, k) != k:
            label[k] = label[label[k]]
            k = label[k]
        return k

    for p, s in enumerate(ta):
        for q, t in enumerate(tb):
            if same and q < p or np.sqrt(((ca[p] - cb[q]) ** 2).sum()) - da[p] - db[q] > far:
                continue
            i, j = _tile_pairs(a[s], b[t], ra[s], rb[t], threshold)
            i, j = i + s.start, j + t.start
            if same:
                i, j = i[i < j], j[i < j]
            for lo in range(0, len(i), 1 << 18):
                pi, pj = i[lo:lo + (1 << 18)], j[lo:lo + (1 << 18)]
                ok = np.einsum("ij,ij->i", x[pi], y[pj]) >= threshold
                pi, pj = pi[ok], pj[ok]
                np.add.at(links_x, pi, n_y[pj])
                np.add.at(links_x if same else links_y, pj, n_x[pi])
                for u, v in zip(rep_x[pi].tolist(), rep_y[pj].tolist()):
                    u, v = root(u), root(v)
                    if u != v:
                        label[max(u, v)] = min(u, v)
    edges = [(k, root(k)) for k in label]
    return links_x, links_y, [e for e in edges if e[0] != e[1]]


def embedding_dedup(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: id_col (whole numbers), n_links (other rows with
    cosine of at least ``threshold``), component_id (the smallest id reachable over
    links) and kept (the row has that id).

    Cases: vectors that are null, zero, or hold null or non-finite components link
    with nothing and are their own component; vectors of different length do not link;
    rows with equal vectors link with one another; rows that repeat an id count as
    rows of their own and share its component; a null id has component_id null and is
    kept, and links nothing; an empty table gives an empty result; other columns are
    not read."""
    rows = staged(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
                  .withColumn("ok", usable(F.col("v")) & F.col("id").isNotNull()), "vectors")
    good = rows.where("ok")
    points = staged(good.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n")).withColumn("dim", F.size("v")), "points")
    found = None
    for dim in sorted(r.dim for r in points.select("dim").distinct().collect()):  # as many as there are vector lengths
        one = points.where(F.col("dim") == dim).drop("dim")
        part = _compare(one, dim, threshold)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = staged(found, "vector_links")
    linked = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n_links"))
    groups = components(found.where("b is not null").select("a", "b"))
    table = (points.select("v", "rep", "n").join(linked, "rep", "left").join(groups, F.col("rep") == F.col("node"), "left")
             .select("v", (F.col("n") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    joined = (good.select("id", "v").join(table, "v").select("id", "n_links", "component_id")
              .union(rows.where("not ok").select("id", F.lit(0).cast("long"), "id")))
    return joined.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _compare(points: DataFrame, dim: int, threshold: float) -> DataFrame:
    """Rows (a, b, n): n links of representative a where b is null, else an edge."""
    spark = points.sparkSession
    axes = spark.sparkContext.broadcast(_axes(points, dim))  # dim * dim numbers
    block = min(BLOCK, max(TILE, BLOCK * 64 // dim))
    n_blocks = max(BLOCKS, math.ceil(points.count() / block))

    def lead(batches):
        for batch in batches:
            first = _unit(batch.column(1), dim) @ axes.value[:, :1]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(first[:, 0])], ["rep", "v", "n", "lead"])

    located = staged(points.select("rep", "v", "n").mapInArrow(lead, "rep long, v array<double>, n long, lead double"), "located")
    # neighbours along the first axis share a block; cut points are quantiles of it
    cuts = located.agg(F.percentile_approx("lead", [k / n_blocks for k in range(1, n_blocks)], 10 * n_blocks)).head()[0] or []
    at = spark.sparkContext.broadcast(np.array(sorted(set(cuts))))

    def blocks(batches):
        for batch in batches:
            # equal leading coordinates are dealt out by id, so that no block outgrows the others
            lo = np.searchsorted(at.value, batch.column(3).to_numpy(), side="left")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lo.astype(np.int32))], ["rep", "v", "n", "lead", "block"])

    blocked = located.mapInArrow(blocks, "rep long, v array<double>, n long, lead double, block int")
    per = blocked.groupBy("block").count().withColumn("k", F.ceil(F.col("count") / (2 * block)))
    start = per.select("block", "k", (F.sum("k").over(Window.orderBy("block")) - F.col("k")).alias("start"))  # one row per block
    placed = staged(blocked.join(F.broadcast(start), "block").select("rep", "v", "n", "lead", (F.col("start") + F.pmod(F.xxhash64("rep"), F.col("k"))).cast("int").alias("block")), "blocks")
    # blocks meet only if their stretches of the first axis come as near as linked vectors do
    edges = sorted(placed.groupBy("block").agg(F.min("lead").alias("lo"), F.max("lead").alias("hi")).collect())  # one row per block
    number, low, high = (np.array([r[k] for r in edges]) for k in range(3))
    far = np.sqrt(2 - 2 * threshold) + SLACK
    first = np.searchsorted(np.maximum.accumulate(high), low - far, side="left") if len(edges) else low
    last = np.searchsorted(np.minimum.accumulate(low[::-1])[::-1], high + far, side="right") - 1 if len(edges) else low
    reach = [(int(b), int(number[i]), int(number[j])) for b, i, j in zip(number, first, last)]
    reach = spark.createDataFrame(reach, "block int, first int, last int")
    pair = F.explode(F.transform(F.sequence("first", "last"), lambda o: F.struct(F.least("block", o).alias("p"), F.greatest("block", o).alias("q"))))
    placed = placed.join(F.broadcast(reach), "block")
    dealt = placed.select("rep", "v", "n", "block", pair.alias("pair")).select("pair.p", "pair.q", "block", "rep", "n", "v")

    def compare(key, rows):
        p, q = key[0].as_py(), key[1].as_py()
        block = rows.column("block").to_numpy()
        v, rep, n = _unit(rows.column("v").combine_chunks(), dim), rows.column("rep").to_numpy(), rows.column("n").to_numpy()
        order = np.lexsort((rep, (v @ axes.value[:, :1])[:, 0]))
        v, rep, n, block = v[order], rep[order], n[order], block[order]
        a, b = block == p, block == q
        x, y, edges = _block_pair(v[a], v[b], rep[a], rep[b], n[a], n[b], axes.value, threshold, p == q)
        ids, count = np.concatenate([rep[a], rep[b]]), np.concatenate([x, y])
        some = count > 0
        e = np.array(edges, np.int64).reshape(-1, 2)
        return pa.table({"a": np.concatenate([ids[some], e[:, 0]]),
                         "b": pa.concat_arrays([pa.nulls(int(some.sum()), pa.int64()), pa.array(e[:, 1])]),
                         "n": np.concatenate([count[some], np.zeros(len(e), np.int64)])})

    return dealt.groupBy("p", "q").applyInArrow(compare, "a long, b long, n long")
