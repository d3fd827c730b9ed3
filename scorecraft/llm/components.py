"""Connected components of a distributed edge list.

Alternating large-star and small-star steps: in a large-star step every node
links its larger neighbours to the smallest node it sees, in a small-star step
its smaller ones and itself; both keep components and turn them into stars in a
logarithmic number of rounds.  Each step is a grouped minimum (combined before
the shuffle) that meets the edges again: the minima are broadcast while the edges are
few (their rows and bytes are counted each round, and there are at most as many
minima), else they are joined with the edges of nodes with very many links dealt over
tasks.  So a hub's edges never meet in one task.  Every round is a written table.

A round without a change ends the search.  Tables are compared by their number of rows
and the sum of the 64-bit hashes of their edges: a table that changed passes for the
same with a probability of 2^-64."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecraft.llm.staging import staged
from scorecraft.operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, dealt_join


def _meet(e: DataFrame, low: DataFrame, few: bool) -> DataFrame:
    """Edges with their node's minimum."""
    return e.join(F.broadcast(low), "u") if few else dealt_join(e, low, "u", "inner")


def _small_star(e: DataFrame, few: bool) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    seen = _meet(e, low, few)
    return seen.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()


def _large_star(e: DataFrame, few: bool) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _meet(both.where("v > u"), low, few).select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of an edge the smallest node reachable
    from it.  Loops, repeated edges and edges with a null end are ignored; a node
    without an edge has no row."""
    e = staged(edges.where(f"`{a}` <> `{b}`").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    state = None
    while True:
        width = F.octet_length(F.col("u").cast("string")) + F.octet_length(F.col("v").cast("string")) + F.lit(32)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(width)).head()
        if now == state or now[0] == 0:
            break
        state = now
        # a large star looks at each edge from both ends
        few = 2 * now[0] <= DEFAULT_BROADCAST_ROWS and 2 * now[2] <= DEFAULT_BROADCAST_BYTES
        e = staged(_small_star(_large_star(e, few), few), "edges")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
