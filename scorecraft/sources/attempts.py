"""The item-attempt fact view, derived from the supplied star schema.

The supplied tables hold no NULLs or sentinel dates, so they are injected by
deterministic expressions of the keys (the same rules run in the DuckDB oracle).
Every row of ``lineitem`` becomes one attempt: nothing is sampled or capped.

Join plan: lineitem looks up its part, orders looks up customer -> nation (orders is a
quarter of the fact rows and four columns wide), then both meet on the order key.
Parts and customers are broadcast while their measured rows and bytes are within the
bounds of ``joins.broadcast_if_small``; beyond them these are sort-merge joins too.
Lineitem is then shuffled on the part key while no column of orders is in its rows; it
is never shuffled on the customer key.  AQE coalesces and splits skew.

At scale the view is materialised once with ``materialise_attempts``: its shuffle
partitions hold a bounded number of rows, so that they are sorted in memory, and the
columns of ``_derived``, which every row yields from its other columns, are not written
but worked out where they are read (``attempts_view``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorecraft.operators.joins import broadcast_if_small
from scorecraft.session import shuffle_partitions
from scorecraft.sources.tables import load_table

# Default dates injected as sentinels.
# Item types and the percent of parts up to which each reaches: two synonym pairs, levels
# on both sides of the 6 % rule, uneven shares.
ITEM_TYPES = [("multipleChoice", 30), ("MultipleChoiceResponse", 38), ("fillInTheBlank", 55), ("FillinBlankResponse", 59),
              ("multipleSelect", 72), ("association", 82), ("choiceMatrix", 89), ("orderList", 94), ("hotSpot", 97), ("drawing", 100)]
HIGH_SENTINEL = "2999-01-01 00:00:00"
LOW_SENTINEL = "1900-01-01 00:00:00"

# Lineitem rows for each shuffle partition of the view (about 100 bytes each while they are sorted).
PARTITION_ROWS = 500_000
# How the view is written: rows of one order are neighbours, and most of their values differ by little.
WRITTEN = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "assessment_item_response_id", "org_id", "section_id",
    "learner_id", "assessment_id", "assessment_instance_id", "learner_attempt_status", "item_type_code_name",
    "response_correctness", "raw_score", "final_score_unweighted", "number_of_distinct_instance_items",
    "number_of_learners", "item_attempt_start_datetime_utc", "item_attempt_end_datetime_utc", "student_start_datetime",
    "student_stop_datetime", "assignment_due_date", "scored_datetime", "was_submitted_datetime_actual", "skewed_minutes")


def _spread() -> Column:
    """Pseudo-random numbers from the keys."""
    return F.col("l_partkey") * 31 + F.col("l_orderkey") * 17 + F.col("l_linenumber") * 7


def _derived() -> dict[str, Column]:
    """Columns of the view that follow from its other columns."""
    c, null, k = F.col, F.lit(None), _spread()
    start = c("item_attempt_start_datetime_utc")
    ntz = lambda s: F.lit(s).cast("timestamp_ntz")
    # long tails for a few percent of the rows
    seconds = {
        "item": F.when(c("l_orderkey") % 101 == 0, F.lit(-3600).cast("long"))
                 .otherwise(60 * (1 + k % 90) * F.when((c("l_partkey") % 23 == 0) | (c("l_suppkey") % 57 == 0), 40).otherwise(1)),
        "student": F.when(c("l_orderkey") % 103 == 1, F.lit(-7200).cast("long"))
                    .otherwise(60 * (5 + k * 3 % 200) * F.when(c("l_suppkey") % 19 == 0, 30).otherwise(1)),
        "due": 3600 * (1 + k * 5 % 300) * F.when((c("l_orderkey") % 29 == 0) | (c("l_suppkey") % 57 == 0), 25).otherwise(1),
    }
    after = lambda name: F.timestamp_add("SECOND", seconds[name], start)
    return {
        "assessment_item_response_id": F.when(c("l_partkey") % 11 == 0, null)
                                        .otherwise(c("l_orderkey") * 10 + c("l_linenumber")),
        "assessment_id": c("l_partkey") % 20,
        "assessment_instance_id": c("l_partkey"),
        "number_of_learners": F.lit(1) + c("l_suppkey") % 40,
        "item_attempt_end_datetime_utc": after("item"),
        "student_start_datetime": F.when(c("l_orderkey") % 97 == 0, null).otherwise(start),
        "student_stop_datetime": F.when(c("l_orderkey") % 97 <= 1, null).otherwise(after("student")),
        "assignment_due_date": F.when(c("response_correctness") == "[unassigned]", null).otherwise(after("due")),
        "was_submitted_datetime_actual": F.when(c("l_suppkey") % 5 == 0, null)
                                          .when(c("learner_id") % 53 == 0, ntz(HIGH_SENTINEL))
                                          .when(c("learner_id") % 53 == 1, ntz(LOW_SENTINEL))
                                          .otherwise(start),
    }


def attempts_view(rows: DataFrame) -> DataFrame:
    """The view over a batch or stream of its rows: columns that were not written are added;
    rows that hold all of them, or come from elsewhere, stay as they are."""
    derived, there = _derived(), set(rows.columns)
    if there >= set(COLUMNS) or not there >= set(COLUMNS) - set(derived):
        return rows
    return rows.select(*[c if c in there else derived[c].alias(c) for c in COLUMNS])


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole view, not written."""
    return attempts_view(_rows(spark, sf_dir))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view's rows without the derived columns."""
    li = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    orders = load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    customer = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = load_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    part = load_table(spark, sf_dir, "part").select("p_partkey", "p_size")

    c = F.col
    null = F.lit(None)
    cust = broadcast_if_small(customer.join(nation, customer.c_nationkey == nation.n_nationkey)
                              .select("c_custkey", "n_nationkey", "n_regionkey"))
    ord_cust = orders.join(cust, c("o_custkey") == c("c_custkey"))
    # fact-to-fact join: both sides grow with the data, so it is a sort-merge
    # join on the order key (never a broadcast of either side).
    j = (li.join(broadcast_if_small(part), c("l_partkey") == c("p_partkey"))
         .join(ord_cust.hint("merge"), c("l_orderkey") == c("o_orderkey")))

    k, share = _spread(), c("l_partkey") % 100
    item_type = None
    for name, top in ITEM_TYPES:
        item_type = F.when(share < top, name) if item_type is None else item_type.when(share < top, name)
    luck = (k * 7919 + c("l_suppkey") * 1047) % 1000
    ease = (F.when(share < 38, 650).when(share < 59, 420).when(share < 89, 250).otherwise(120)
            + F.least(k * 3 % 200, F.lit(150)) + c("p_size"))
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        c("n_regionkey").alias("org_id"),
        c("n_nationkey").alias("section_id"),
        c("o_custkey").alias("learner_id"),
        F.when(c("o_orderstatus") == "F", "fully scored")
         .when(c("o_orderstatus") == "O", "in progress")
         .otherwise("assigned").alias("learner_attempt_status"),
        F.when(c("p_size") % 10 == 0, null).otherwise(item_type).alias("item_type_code_name"),
        F.when(c("l_returnflag") == "A", "[unassigned]")
         .when(c("l_returnflag") == "R", "correct").alias("response_correctness"),
        F.when(c("l_partkey") % 13 == 0, null)
         .when(luck < ease, c("l_quantity"))
         .otherwise(F.lit(0.0)).alias("raw_score"),
        F.when(c("l_discount") < 0.01, F.lit(0.0))
         .otherwise(c("l_discount") * 100).alias("final_score_unweighted"),
        c("p_size").alias("number_of_distinct_instance_items"),
        c("o_orderdate").alias("item_attempt_start_datetime_utc"),
        F.when(c("l_linenumber") == 1, null).otherwise(c("l_shipdate")).alias("scored_datetime"),
        F.when(c("l_partkey") % 10 == 0, c("l_extendedprice") * 10)
         .otherwise(c("l_extendedprice")).alias("skewed_minutes"),
    )


def materialise_attempts(spark: SparkSession, sf_dir: str, path: str,
                         partition_by: list[str] | None = None) -> DataFrame:
    """Write the view once (shared folder) and read it back: later stages scan
    parquet with pushdown instead of re-running three shuffle joins.
    ``partition_by`` (e.g. the organisation) adds partition pruning at scale; a
    derived column that it names is written too."""
    from scorecraft.sources.files import stage_parquet
    rows = _rows(spark, sf_dir)
    derived = _derived()
    rows = rows.withColumns({n: derived[n] for n in partition_by or [] if n in derived})
    n_rows = load_table(spark, sf_dir, "lineitem").count()  # from the files' footers
    with shuffle_partitions(spark, -(-n_rows // PARTITION_ROWS)):
        return attempts_view(stage_parquet(spark, rows, path, partition_by=partition_by, options=WRITTEN))
