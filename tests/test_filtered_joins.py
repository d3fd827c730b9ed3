"""Shuffle joins beyond the broadcast bound: the key filter and the dealing of hot keys."""
import re

import pytest
from pyspark.sql import functions as F

from scorecraft.operators import clean, joins


def _plain(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def facts(spark):
    return spark.range(20000).select(F.when(F.col("id") % 10 == 3, None).when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 701)).alias("k"),
                                     F.col("id").alias("v"), (F.col("id") % 3).alias("clash.name"))


@pytest.fixture(scope="module")
def lookup(spark):
    rows = [("hot", 1), ("hot", 2), (None, 3)] + [(f"k{n}", n) for n in range(0, 700, 7)] + [(f"unused{n}", n) for n in range(50)]
    return spark.createDataFrame(rows, "k string, w long")


@pytest.mark.parametrize("how", ["inner", "left", "left_outer", "left_anti"])
@pytest.mark.parametrize("kind", ["string", "filterless"])
def test_results_are_those_of_a_join(spark, facts, lookup, how, kind, monkeypatch):
    if kind == "filterless":
        monkeypatch.setattr(joins, "FILTER_SHARE", 0.0)
    got = joins.sized_join(facts, lookup, "k", how, max_rows=0)
    want = facts.join(lookup, "k", how)
    assert _plain(got.select(*want.columns if "clash.name" not in want.columns else [F.col(f"`{c}`") for c in want.columns])) == _plain(
        want.select(*[F.col(f"`{c}`") for c in want.columns]))


def test_whole_number_keys_and_few_bits(spark, monkeypatch):
    """A filter so small that it lets wrong keys through leaves the result as it is."""
    monkeypatch.setattr(joins, "FILTER_BITS", 256)
    left = spark.range(5000).withColumn("x", F.col("id") * 2)
    right = spark.range(0, 5000, 100).withColumn("w", F.lit(1))
    assert _plain(joins.sized_join(left, right, "id", "left_anti", max_rows=0)) == _plain(left.where("id % 100 <> 0"))
    assert joins.may_match(left, joins.key_filter(right, "id"), "id").where("__maybe").count() > 200


def test_only_rows_that_may_match_are_shuffled(spark):
    """The anti-join of few offending ids leaves nearly all rows out of its shuffle."""
    df = spark.range(50000).select((F.col("id") % 20000).alias("assessment_item_response_id"), F.col("id").alias("v"), (F.col("id") % 20000 < 40).alias("bad"))
    real = joins.DEFAULT_BROADCAST_ROWS
    ids = df.where("bad").select("assessment_item_response_id").distinct()
    got = joins.sized_join(df, ids, "assessment_item_response_id", "left_anti", max_rows=0)
    assert got.count() == 50000 - 120 and real == joins.DEFAULT_BROADCAST_ROWS
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    anti = plan[plan.index("LeftAnti"):]
    # below the anti-join the filter's join stands, and only rows with their bit set pass it
    assert re.search(r"Filter .*getbit|Filter .*bit_get", anti) and "Union" in plan[:plan.index("LeftAnti")]
    maybe = joins.may_match(df, joins.key_filter(ids, "assessment_item_response_id"), "assessment_item_response_id").where("__maybe").count()
    assert 120 <= maybe < 150
    assert clean.remove_bad_ids(df, F.col("bad")).count() == 50000 - 120


def test_a_hot_key_is_dealt_over_tasks(spark, facts, lookup):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = joins.hot_keys(facts, "k")  # others may be named too, which only costs copies of their lookup rows
        assert "hot" in found and len(found) <= 2 / joins.HOT_SHARE
        tasks = lambda d: d.where("k = 'hot'").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        n = facts.where("k = 'hot'").count()
        spread = tasks(joins.sized_join(facts, lookup, "k", "inner", max_rows=0))
        assert sum(r["count"] for r in spread) == 2 * n and len(spread) >= 6 and max(r["count"] for r in spread) < n
        assert len(tasks(facts.join(lookup, "k"))) == 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_empty_sides(spark, facts, lookup):
    for how, n in (("inner", 0), ("left", 20000), ("left_anti", 20000)):
        assert joins.sized_join(facts, lookup.limit(0), "k", how, max_rows=-1).count() == n
        assert joins.sized_join(facts.limit(0), lookup, "k", how, max_rows=0).count() == 0
