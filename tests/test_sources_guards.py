"""The derived data exercises every operator; broadcasts are measured; nothing stays cached."""
import pytest
from pyspark.sql import functions as F

from scorecraft import session
from scorecraft.operators import joins, relate, stepwise
from scorecraft.plans.catalog import load_all

SF = "/root/testdata/sf0.01"


def test_imputation_and_levels_are_not_empty(spark):
    q = load_all()
    audit = {(r["step"], r["data"]): r for r in q["audit_table"](spark, SF).collect()}
    assert all(audit[(n, "all")]["removed"] > 0 for n in (1, 2, 3))
    assert all(audit[(n, s)]["imputed"] > 0 for n in (5, 6, 7) for s in ("train", "valid"))
    flags = q["flag_any_all"](spark, SF).head()
    assert flags["any_true"] > 0 and flags["all_true"] > 0
    k1 = q["iqr_impute"](spark, SF).head().asDict()
    assert all(v > 0 for k, v in k1.items() if k.startswith("n_"))
    levels = {r[0] for r in q["collapse_levels"](spark, SF).collect()}
    assert len(levels) >= 4 and not levels & {"MultipleChoiceResponse", "FillinBlankResponse"} and "Other" in levels


def test_scores_separate(spark):
    cells = {(r["label"], r["prediction"]): r["count"] for r in load_all()["confusion"](spark, SF).collect()}
    n = sum(cells.values())
    assert cells[(0, 0)] > 0.05 * n and cells[(1, 0)] > 0.05 * n
    assert load_all()["auc"](spark, SF).head()["auc"] > 0.6


def test_long_strings_are_measured(spark):
    wide = spark.range(1000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 100_000).alias("v"))
    left = spark.range(2000).withColumnRenamed("id", "k")
    plan = joins.sized_join(left, wide, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    small = joins.sized_join(left, wide.limit(10), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in small


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())


def test_nothing_stays_cached(spark):
    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    for name in ("woe", "crosstab_cube", "swoe", "assoc_matrix", "collapse_levels", "post_split_impute", "recount_impute"):
        if name in load_all():
            load_all()[name](spark, "/root/testdata/sf0.001").count()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before


def test_eta_does_not_depend_on_the_mean(spark):
    df = spark.range(3000).select((F.col("id") % 3).cast("string").alias("g"), (F.col("id") % 3 + F.sin("id")).alias("x"))
    shifted = df.withColumn("x", F.col("x") + 1.6e9)
    a, b = (relate.correlation_ratio(d, ["g"], ["x"]).head()["eta"] for d in (df, shifted))
    assert a == pytest.approx(b, abs=1e-5) and 0.1 < a < 1


@pytest.mark.parametrize("strings,names", [("drop", {"x"}), ("dummy", {"g_a", "g_b", "g_c.d", "x"}), ("dummy_dropfirst", {"g_b", "g_c.d", "x"})])
def test_string_columns_in_selection(spark, strings, names):
    df = spark.range(900).select(F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c.d")), (F.col("id") % 3 + 1).cast("int")).alias("g"),
                                 F.sin("id").alias("x"), (F.col("id") % 3 * 2 + F.sin("id") + F.cos(F.col("id") * 7)).alias("y"))
    assert set(stepwise.design_of(df, ["g", "x"], strings).names) == names
    sel = stepwise.forward_selection(df, ["g", "x"], "y", "linear", "aic", strings=strings)
    assert set(sel.selected) - {"intercept"} <= names and "x" in sel.selected
    if strings == "dummy_dropfirst":
        assert {"g_b", "g_c.d"} <= set(sel.selected)
        back = stepwise.backward_selection(df, ["g", "x"], "y", "linear", "aic", strings=strings)
        assert {"g_b", "g_c.d", "x"} <= set(back.selected)
