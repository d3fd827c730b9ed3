"""Classification metrics from label and prediction/score columns.

Label and prediction stay in one row (``model.transform`` keeps both), so no
column-wise concatenation is needed (J6).  Counts are one aggregate; the ROC
curve needs cumulative counts by descending score, which are computed without
a global single-task window: the counts per score are grouped once, dealt into
ranges by Spark's range partitioning and written with the range's number; totals per
range (one row each) give its offset, and a window partitioned by range finishes the
running sums."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorecraft.session import staged

ROWS_PER_RANGE = 1_000_000


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """tp, fp, tn, fn for a binary 0/1 label and prediction, one pass."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    return df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Dense 2x2 matrix in long form (label, prediction, count)."""
    c = confusion_counts(df, label, pred)
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return c.select(F.inline(F.array(*[F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"),
                                                F.col(k).cast("long").alias("count")) for a, b, k in cells])))


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall (0 when undefined, as scikit-learn warns)."""
    c = confusion_counts(df, label, pred)
    tp, fp, tn, fn = (F.col(k).cast("double") for k in ("tp", "fp", "tn", "fn"))
    return c.select(
        "tp", "fp", "tn", "fn",
        F.try_divide(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class precision/recall/f1/support, accuracy, macro and weighted avg."""
    c = confusion_counts(df, label, pred)
    tp, fp, tn, fn = (F.col(k).cast("double") for k in ("tp", "fp", "tn", "fn"))
    z = F.lit(0.0)

    def prf(t, f_p, f_n):
        p = F.coalesce(F.try_divide(t, t + f_p), z)
        r = F.coalesce(F.try_divide(t, t + f_n), z)
        f1 = F.coalesce(F.try_divide(2 * p * r, p + r), z)
        return p, r, f1

    p1, r1, f1 = prf(tp, fp, fn)
    p0, r0, f0 = prf(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    acc = F.try_divide(tp + tn, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), s.alias("support"))
    return c.select(F.inline(F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", F.try_divide(p0 * s0 + p1 * s1, n), F.try_divide(r0 * s0 + r1 * s1, n),
            F.try_divide(f0 * s0 + f1 * s1, n), n))))


def _score_groups(df: DataFrame, label: str, score: str) -> DataFrame:
    y = F.col(label).cast("int")
    return (df.where(F.col(score).isNotNull() & y.isNotNull())
            .groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg")))


def roc_points(df: DataFrame, label: str = "label", score: str = "score",
               rows_per_range: int = ROWS_PER_RANGE) -> tuple[DataFrame, int, int]:
    """(points, P, N): one row per distinct score with cumulative positives and
    negatives at threshold >= score.  The number of ranges grows with the rows, so
    that a range holds about ``rows_per_range`` distinct scores at most."""
    ranges = max(1, math.ceil(df.count() / rows_per_range))
    groups = _score_groups(df, label, score).repartitionByRange(ranges, F.desc("score"))
    groups = staged(groups.withColumn("rng", F.spark_partition_id()), "scores")
    per = groups.groupBy("rng").agg(F.sum("pos").alias("rp"), F.sum("neg").alias("rn"))
    before = Window.orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offs = per.select("rng", F.coalesce(F.sum("rp").over(before), F.lit(0)).alias("off_pos"),
                      F.coalesce(F.sum("rn").over(before), F.lit(0)).alias("off_neg"))
    tot = per.agg(F.sum("rp").alias("p"), F.sum("rn").alias("n")).first()
    w = Window.partitionBy("rng").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    pts = (groups.join(F.broadcast(offs), "rng")
           .select("rng", "score", "pos", "neg",
                   (F.col("off_pos") + F.sum("pos").over(w)).alias("cum_pos"),
                   (F.col("off_neg") + F.sum("neg").over(w)).alias("cum_neg")))
    return pts, int(tot["p"] or 0), int(tot["n"] or 0)


def _corners(pts: DataFrame) -> DataFrame:
    """Points at which the curve turns: a point goes if it lies on the line from the one before
    to the one after it (steps of one slope).  The last step of a range is compared with the
    first step of the next one, which is carried over as a row per range."""
    first = pts.groupBy("rng").agg(F.max_by(F.struct("pos", "neg"), "score").alias("first"))
    after = first.select("rng", F.lead("first").over(Window.orderBy("rng")).alias("beyond"))  # one row per range
    step = F.coalesce(F.lead(F.struct("pos", "neg")).over(Window.partitionBy("rng").orderBy(F.desc("score"))), F.col("beyond"))
    # bigint counts: products of two are compared as decimals
    wide = lambda c: c.cast("decimal(19,0)")
    on_line = wide(F.col("pos")) * wide(F.col("step.neg")) == wide(F.col("neg")) * wide(F.col("step.pos"))
    return pts.join(F.broadcast(after), "rng").withColumn("step", step).where(F.col("step").isNull() | ~on_line)


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", drop_collinear: bool = False) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score plus the (0, 0) point
    at threshold +inf.  Collinear points are kept (Q34) unless ``drop_collinear``;
    the area under the curve is the same."""
    pts, P, N = roc_points(df, label, score)
    if drop_collinear:
        pts = _corners(pts)
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(pts.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_neg").cast("double"), F.lit(float(N))).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), F.lit(float(P))).alias("tpr")))


def auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Trapezoid area under the ROC curve.  Each distinct score adds
    neg * (2*cum_pos - pos) / (2*P*N): the trapezoid between it and the previous
    point, so no lag across ranges is needed."""
    pts, P, N = roc_points(df, label, score)
    area = F.sum(F.col("neg").cast("double") * (2.0 * F.col("cum_pos") - F.col("pos")))
    return pts.agg(F.try_divide(area, F.lit(2.0 * P * N)).alias("auc"),
                   F.lit(P).cast("long").alias("positives"), F.lit(N).cast("long").alias("negatives"))


def auc_hard(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """AUC of hard 0/1 predictions (= balanced accuracy)."""
    return auc(df, label, pred)


def score_column(coefs: dict, intercept: float) -> Column:
    """M4 by coefficients: sigmoid(b0 + sum b_i x_i)."""
    from scorecraft.functions.links import linear_predictor, sigmoid
    return sigmoid(linear_predictor(coefs, intercept))
