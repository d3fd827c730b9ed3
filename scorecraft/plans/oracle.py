"""Oracle SQL (DuckDB dialect) for every catalogue query with a SQL form.

Each string is self-contained: the ``attempts`` view is spelled out as a CTE
over the supplied tables, with the same null-injection rules as the Spark
source.  Computed doubles are rounded to 6 decimals on both sides."""

from __future__ import annotations

from scorecraft.sources.attempts import ITEM_TYPES

_K = "(l_partkey * 31 + l_orderkey * 17 + l_linenumber * 7)"
_ITEM_TYPE = "CASE " + " ".join(f"WHEN l_partkey % 100 < {top} THEN '{name}'" for name, top in ITEM_TYPES) + " END"

ATTEMPTS_CTE = f"""attempts AS (
SELECT
  l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS assessment_item_response_id,
  n_regionkey AS org_id,
  n_nationkey AS section_id,
  o_custkey AS learner_id,
  l_partkey % 20 AS assessment_id,
  l_partkey AS assessment_instance_id,
  CASE o_orderstatus WHEN 'F' THEN 'fully scored' WHEN 'O' THEN 'in progress' ELSE 'assigned' END AS learner_attempt_status,
  CASE WHEN p_size % 10 = 0 THEN NULL ELSE {_ITEM_TYPE} END AS item_type_code_name,
  CASE l_returnflag WHEN 'A' THEN '[unassigned]' WHEN 'R' THEN 'correct' ELSE NULL END AS response_correctness,
  CASE WHEN l_partkey % 13 = 0 THEN NULL
       WHEN ({_K} * 7919 + l_suppkey * 1047) % 1000 <
         CASE WHEN l_partkey % 100 < 38 THEN 650 WHEN l_partkey % 100 < 59 THEN 420 WHEN l_partkey % 100 < 89 THEN 250 ELSE 120 END
         + least({_K} * 3 % 200, 150) + p_size THEN l_quantity
       ELSE 0 END AS raw_score,
  CASE WHEN l_discount < 0.01 THEN 0 ELSE l_discount * 100 END AS final_score_unweighted,
  p_size AS number_of_distinct_instance_items,
  1 + (l_suppkey % 40) AS number_of_learners,
  o_orderdate AS item_attempt_start_datetime_utc,
  o_orderdate + to_seconds(CASE WHEN l_orderkey % 101 = 0 THEN -3600
    ELSE 60 * (1 + {_K} % 90) * CASE WHEN l_partkey % 23 = 0 OR l_suppkey % 57 = 0 THEN 40 ELSE 1 END END) AS item_attempt_end_datetime_utc,
  CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE o_orderdate END AS student_start_datetime,
  CASE WHEN l_orderkey % 97 <= 1 THEN NULL ELSE o_orderdate + to_seconds(CASE WHEN l_orderkey % 103 = 1 THEN -7200
    ELSE 60 * (5 + {_K} * 3 % 200) * CASE WHEN l_suppkey % 19 = 0 THEN 30 ELSE 1 END END) END AS student_stop_datetime,
  CASE WHEN l_returnflag = 'A' THEN NULL
    ELSE o_orderdate + to_seconds(3600 * (1 + {_K} * 5 % 300) * CASE WHEN l_orderkey % 29 = 0 OR l_suppkey % 57 = 0 THEN 25 ELSE 1 END) END AS assignment_due_date,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE l_shipdate END AS scored_datetime,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL
       WHEN o_custkey % 53 = 0 THEN CAST('2999-01-01 00:00:00' AS TIMESTAMP)
       WHEN o_custkey % 53 = 1 THEN CAST('1900-01-01 00:00:00' AS TIMESTAMP)
       ELSE CAST(o_orderdate AS TIMESTAMP) END AS was_submitted_datetime_actual,
  CASE WHEN l_partkey % 10 = 0 THEN l_extendedprice * 10 ELSE l_extendedprice END AS skewed_minutes
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey
)"""

# C1 -> C5 -> B3 -> B5 as a CTE named ``study`` (needs ``attempts``).
STUDY_CTE = """study AS (
SELECT *,
  (epoch(item_attempt_end_datetime_utc) - epoch(item_attempt_start_datetime_utc)) / 60.0 AS item_attempt_duration_mins,
  (epoch(student_stop_datetime) - epoch(student_start_datetime)) / 60.0 AS student_duration_mins,
  (epoch(assignment_due_date) - epoch(student_start_datetime)) / 60.0 AS timeliness_duration_mins,
  CASE WHEN raw_score > 0 THEN 1 ELSE 0 END AS target
FROM attempts
WHERE assessment_item_response_id IS NOT NULL AND learner_attempt_status = 'fully scored'
  AND item_attempt_start_datetime_utc <= item_attempt_end_datetime_utc
)"""


def with_attempts(select: str, *ctes: str) -> str:
    """``WITH attempts AS (...), <ctes> <select>``."""
    return "WITH " + ",\n".join([ATTEMPTS_CTE, *ctes]) + "\n" + select


