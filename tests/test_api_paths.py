"""Library paths not exercised by the catalogue: fit on another frame, Spark ML
dummy vectors, error bounds, CSV inference, staging with partitions."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from scorecraft.functions import dates
from scorecraft.operators import encode, joins
from scorecraft.plans import cleaning
from scorecraft.sources import files


def _frame(spark, n, shift=0.0):
    rows = []
    for i in range(n):
        rows.append((f"t{i % 3}", i % 2, float(i + shift), float(2 * i + shift), float(3 * i + shift)))
    return spark.createDataFrame(rows, "item_type_code_name string, target int, student_duration_mins double, "
                                       "timeliness_duration_mins double, item_attempt_duration_mins double")


def test_impute_split_fit_on_train(spark):
    train, valid = _frame(spark, 200), _frame(spark, 50, shift=1000.0)
    own = cleaning.impute_split(valid)
    fitted = cleaning.impute_split(valid, fit_on=train)
    # with train parameters every shifted validation value is above train's fence
    assert fitted.where("student_duration_mins_imputed").count() == 50
    assert own.where("student_duration_mins_imputed").count() == 0


def test_dummy_vector_drops_first_level(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "lvl string")
    out = {r["lvl"]: r["lvl_vec"].toArray().tolist() for r in encode.dummy_vector(df, "lvl").collect()}
    assert out["a"] == [0.0, 0.0] and sum(out["b"]) == 1 and sum(out["c"]) == 1 and out[None] == [0.0, 0.0]


def test_dummy_columns_modes(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "lvl string, x int")
    assert encode.dummy_columns(df, ["lvl"]).columns == ["x", "lvl_b"]
    assert encode.dummy_columns(df, ["lvl"], mode="dummy").columns == ["x", "lvl_a", "lvl_b"]
    assert encode.dummy_columns(df, ["lvl"], mode="drop").columns == ["x"]
    with pytest.raises(ValueError):
        encode.dummy_columns(df, ["lvl"], max_levels=1)


def test_id_to_name_needs_enough_names(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    with pytest.raises(ValueError):
        joins.id_to_name(df, "k", "name", ["A", "B"])
    got = {r["k"]: r["name"] for r in joins.id_to_name(df, "k", "name", ["A", "B", "C"]).collect()}
    assert got == {1: "A", 2: "B", 3: "C"}


def test_csv_inference_and_partitioned_stage(spark):
    d = tempfile.mkdtemp(prefix="scorecraft-csv-")
    df = spark.createDataFrame([(1, "x", 2.5), (2, "y", 3.5)], "a int, b string, c double")
    files.write_csv(df, os.path.join(d, "csv"))
    back = files.read_csv(spark, os.path.join(d, "csv"), infer=True)
    assert dict(back.dtypes) == {"a": "int", "b": "string", "c": "double"}
    staged = files.stage_parquet(spark, df, os.path.join(d, "pq"), partition_by=["b"])
    assert staged.where(F.col("b") == "x").count() == 1


def test_cast_timestamps_bad_text_is_null(spark):
    df = spark.createDataFrame([("2020-01-02 03:04:05",), ("garbage",)], "d string")
    got = [r["d"] for r in dates.cast_timestamps(df, ["d"]).collect()]
    assert got[0] is not None and got[1] is None


def test_sentinel_nulling_uses_explicit_as_of(spark):
    df = spark.createDataFrame([("2999-01-01 00:00:00",), ("2020-05-01 00:00:00",)], "d string") \
        .select(F.col("d").cast("timestamp").alias("d"))
    out = dates.null_sentinel_dates(df, ["d"], "2020-06-01 00:00:00").collect()
    assert out[0]["d"] is None and out[1]["d"] is not None


def test_read_dictionary_csv(spark):
    from scorecraft.sources import dictionary as dct
    d = tempfile.mkdtemp(prefix="scorecraft-dict-")
    rows = [(f, c, t, f"about {f}") for f, c, t in dct.DICTIONARY]
    files.write_csv(spark.createDataFrame(rows, dct.DICTIONARY_SCHEMA), os.path.join(d, "dict"))
    back = dct.read_dictionary(spark, os.path.join(d, "dict"))
    assert back.count() == len(dct.DICTIONARY)
    cats = {r["category"]: r["n_fields"] for r in dct.var_categories(back.drop("description")).collect()}
    assert sum(cats.values()) == len(dct.DICTIONARY) and "Item Attempt" in cats


def test_partitioned_fact_view_prunes(spark):
    from scorecraft.sources.attempts import materialise_attempts
    d = tempfile.mkdtemp(prefix="scorecraft-att-")
    src = "/root/testdata/sf0.001"
    m = materialise_attempts(spark, src, os.path.join(d, "att"), partition_by=["org_id"])
    q = m.where(F.col("org_id") == 1)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "org_id" in plan
    assert q.count() == m.where(F.col("org_id") == 1).count() > 0
