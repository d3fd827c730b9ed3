"""Exact quantiles with linear interpolation (pandas ``quantile``, DuckDB
``quantile_cont``), computed without gathering a group into one task and without
shuffling a column.

Spark's exact ``percentile`` keeps every distinct value of a group in one buffer
and merges it in one task: unbounded for a 100 TB column.  Here:

1. one aggregate counts all columns and sketches them
   (``percentile_approx``, merged from bounded partial sketches).  The sketch's
   error bound gives a bracket of values around every wanted quantile;
2. a second aggregate counts the rows under each bracket, and the frequencies of the
   values inside brackets are combined before the shuffle: about 4 / SKETCH_ACCURACY of a
   continuous column leaves the map side.  No row is expanded by its columns;
3. the values at the wanted ranks are read from the brackets by a window per
   bracket.  A bracket with more than ``max_leaf`` distinct values is first narrowed
   on its own small table, round by round; a round that does not shrink it is an
   error.  A bracket that misses its rank is widened to the whole column.

Only bounds and counts per column and quantile reach the driver.  ``approx=True``
gives the one-pass sketch answer instead."""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_LEAF = 1_000_000
BUCKETS = 64
SKETCH_ACCURACY = 20_000


def _values(df: DataFrame, cols, value_filter=None) -> DataFrame:
    """Columns v0, v1, ...: the values as double, NULL where they are NaN or filtered out."""
    out = []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`").cast("double")
        ok = ~F.isnan(v)
        out.append(F.when(ok & value_filter(v) if value_filter is not None else ok, v).alias(f"v{i}"))
    return df.select(*out)


def _frequencies(rows: DataFrame, segs: list[dict]) -> DataFrame:
    """(seg, value, cnt) inside each bracket; value NULL counts the rows under it."""
    v = lambda s: F.col(s["column"])
    inside = [v(s).between(F.lit(s["lo"]), F.lit(s["hi"])) for s in segs]
    kept = F.filter(F.array(*[F.struct(F.lit(s["id"]).alias("seg"), F.when(i, v(s)).alias("value")) for s, i in zip(segs, inside)]),
                    lambda x: x["value"].isNotNull())
    found = (rows.where(reduce(or_, inside)).select(F.inline(kept)).groupBy("seg", "value").agg(F.count(F.lit(1)).alias("cnt")))
    under = rows.agg(*[F.count_if(v(s) < F.lit(s["lo"])).alias(f"n{k}") for k, s in enumerate(segs)])
    under = under.select(F.inline(F.array(*[F.struct(F.lit(s["id"]).alias("seg"), F.lit(None).cast("double").alias("value"), F.col(f"n{k}").alias("cnt"))
                                            for k, s in enumerate(segs)])))
    return found.unionByName(under.where("cnt > 0"))


def _narrow(freq: DataFrame, segs: list[dict], buckets: int) -> None:
    """Shrink brackets to the one of ``buckets`` parts that holds their ranks (a bracket
    whose two ranks fall in different parts keeps both and what lies between)."""
    spark = freq.sparkSession
    frame = spark.createDataFrame([(s["id"], s["lo"], s["hi"]) for s in segs], "seg int, lo double, hi double")
    rows = freq.join(F.broadcast(frame), "seg").where(F.col("value").between(F.col("lo"), F.col("hi"))).select("seg", "value", "cnt")
    bounds = {r["seg"]: sorted(set(r["b"])) for r in rows.groupBy("seg").agg(
        F.percentile_approx("value", [k / buckets for k in range(1, buckets)], SKETCH_ACCURACY).alias("b")).collect()}
    cuts = spark.createDataFrame(list(bounds.items()), "seg int, b array<double>")
    part = F.size(F.filter("b", lambda x: x < F.col("value"))).alias("part")
    parts: dict = {}
    for r in (rows.join(F.broadcast(cuts), "seg").select("seg", part, "value", "cnt").groupBy("seg", "part")
              .agg(F.sum("cnt").alias("n"), F.count(F.lit(1)).alias("d"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()):
        parts.setdefault(r["seg"], []).append(r)
    for s in segs:
        before, kept = s["below"], []
        for r in sorted(parts[s["id"]], key=lambda r: r["part"]):
            if any(before <= k < before + r["n"] for k in s["ranks"]) or kept and max(s["ranks"]) >= before:
                kept.append((before, r))
            before += r["n"]
        size = sum(r["d"] for _, r in kept)
        if size >= s["size"]:
            raise RuntimeError(f"{s['variable']}: narrowing made no progress at {size} distinct values")
        s.update(below=kept[0][0], lo=kept[0][1]["lo"], hi=kept[-1][1]["hi"], size=size)


def _read(freq: DataFrame, segs: list[dict], buckets: int, max_leaf: int) -> dict:
    """{(variable, rank): value} from brackets that hold their ranks."""
    while big := [s for s in segs if s["size"] > max_leaf and s["lo"] < s["hi"]]:
        _narrow(freq, big, buckets)
    spark = freq.sparkSession
    frame = spark.createDataFrame([(s["id"], s["variable"], s["lo"], s["hi"], s["below"], sorted(s["ranks"])) for s in segs],
                                  "seg int, variable string, lo double, hi double, below long, ranks array<long>")
    w = Window.partitionBy("seg").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    rows = (freq.join(F.broadcast(frame), "seg").where(F.col("value").between(F.col("lo"), F.col("hi")))
            .withColumn("end", F.col("below") + F.sum("cnt").over(w)))
    hit = rows.select("variable", "value", "end", "cnt", F.explode("ranks").alias("rank")).where(
        (F.col("rank") >= F.col("end") - F.col("cnt")) & (F.col("rank") < F.col("end")))
    return {(r["variable"], r["rank"]): r["value"] for r in hit.select("variable", "rank", "value").collect()}


def quantile_values(df: DataFrame, cols, probs, value_filter=None, approx: bool = False,
                    max_leaf: int = MAX_LEAF, buckets: int = BUCKETS, accuracy: int = SKETCH_ACCURACY) -> dict:
    """{(variable, p): value}; value is None for a column without values."""
    cols, probs = list(cols), [float(p) for p in probs]
    rows = _values(df, cols, value_filter)
    slack = 2.0 / accuracy  # the sketch may be off by 1 / accuracy
    fracs = probs if approx else [f for p in probs for f in (max(0.0, p - slack), min(1.0, p + slack))]
    one = rows.agg(*[a for i in range(len(cols)) for a in (F.count(f"v{i}").alias(f"n{i}"), F.min(f"v{i}").alias(f"lo{i}"), F.max(f"v{i}").alias(f"hi{i}"),
                                                           F.percentile_approx(f"v{i}", fracs, accuracy).alias(f"q{i}"))]).first() if cols else None
    seen = {c: {k: one[f"{k}{i}"] for k in ("n", "lo", "hi", "q")} for i, c in enumerate(cols) if one[f"n{i}"]}
    if approx:
        return {(c, p): seen[c]["q"][k] if c in seen else None for c in cols for k, p in enumerate(probs)}
    segs = []
    for c, r in seen.items():
        for k, p in enumerate(probs):
            h = (r["n"] - 1) * p
            segs.append({"id": len(segs), "variable": c, "column": f"v{cols.index(c)}", "ranks": {math.floor(h), math.ceil(h)},
                         "lo": r["lo"] if p <= slack else r["q"][2 * k], "hi": r["hi"] if p >= 1 - slack else r["q"][2 * k + 1]})
    found: dict = {}
    while segs:
        freq = _frequencies(rows, segs).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            inside = F.col("value").isNotNull()
            stat = {r["seg"]: r for r in freq.groupBy("seg").agg(
                F.sum(F.when(~inside, F.col("cnt"))).alias("below"), F.sum(F.when(inside, F.col("cnt"))).alias("n"),
                F.count("value").alias("d")).collect()}
            good, missed = [], []
            for s in segs:
                r = stat.get(s["id"])
                below, n = (int(r["below"] or 0), int(r["n"] or 0)) if r else (0, 0)
                s.update(below=below, size=int(r["d"]) if r else 0)
                (good if below <= min(s["ranks"]) and max(s["ranks"]) < below + n else missed).append(s)
            if good:
                found.update(_read(freq, good, buckets, max_leaf))
        finally:
            freq.unpersist()
        for s in missed:
            whole = seen[s["variable"]]
            if (s["lo"], s["hi"]) == (whole["lo"], whole["hi"]):
                raise RuntimeError(f"{s['variable']}: its values changed between two passes")
            s.update(lo=whole["lo"], hi=whole["hi"])
        segs = missed
    out = {}
    for c in cols:
        for p in probs:
            if c not in seen:
                out[(c, p)] = None
                continue
            h = (seen[c]["n"] - 1) * p
            low, high = found[(c, math.floor(h))], found[(c, math.ceil(h))]
            out[(c, p)] = low + (h - math.floor(h)) * (high - low)
    return out


def quantiles(df: DataFrame, cols, probs, value_filter=None, approx: bool = False) -> DataFrame:
    """Long form (variable, probability, value)."""
    vals = quantile_values(df, cols, probs, value_filter, approx)
    return df.sparkSession.createDataFrame(
        [(c, p, vals[(c, p)]) for c in cols for p in [float(x) for x in probs]],
        "variable string, probability double, value double")
