"""Catalogue: models, scoring and evaluation (M, N, E17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorecraft.functions.links import logit, sigmoid
from scorecraft.operators import evaluate, model, stepwise
from scorecraft.plans import prep
from scorecraft.plans.catalog import att, query, rounded, tbl
from scorecraft.plans.oracle import STUDY_CTE, with_attempts

_SW = """sw AS (SELECT item_type_code_name,
  ln((count_if(target = 1) + 24 * (SELECT avg(target) FROM study))
     / (count_if(target = 0) + 24 * (1 - (SELECT avg(target) FROM study)))) AS swoe
  FROM study GROUP BY 1)"""
_SC = """sc AS (SELECT s.target AS label,
  1.0 / (1.0 + exp(-(-0.199966 + 0.000709 * s.student_duration_mins + 0.000003 * s.timeliness_duration_mins
                     + 0.979045 * sw.swoe + 0.008417 * s.number_of_distinct_instance_items))) AS score
  FROM study s JOIN sw ON s.item_type_code_name = sw.item_type_code_name
  WHERE s.student_duration_mins IS NOT NULL AND s.timeliness_duration_mins IS NOT NULL)"""
_SCP = "scp AS (SELECT label, score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM sc)"
_CNT = """cnt AS (SELECT count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 1) AS fp,
  count_if(label = 0 AND prediction = 0) AS tn, count_if(label = 1 AND prediction = 0) AS fn FROM scp)"""
_EVAL = [STUDY_CTE, _SW, _SC, _SCP]


def _scored(spark, sf):
    return prep.scored_frame(att(spark, sf))


# ---------------------------------------------------------- M4, E17: scoring

@query("score_expr", with_attempts("""
SELECT label, count(*) AS n_rows, round(avg(score), 6) AS mean_score, count_if(prediction = 1) AS n_positive
FROM scp GROUP BY label""", *_EVAL))
def q_score_expr(spark, sf):
    """Probability from the fixed fitted formula, class = p > 0.5."""
    s = _scored(spark, sf)
    return rounded(s.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), F.avg("score").alias("mean_score"),
                                          F.count_if(F.col("prediction") == 1).alias("n_positive")))


@query("logit_sigmoid", with_attempts("""
SELECT number_of_distinct_instance_items AS items, count(*) AS n_rows,
       round(1.0 / (1.0 + exp(-(8.19393897 - 0.54291739 * number_of_distinct_instance_items))), 6) AS p,
       round(ln(p_raw / (1 - p_raw)), 6) AS log_odds
FROM (SELECT number_of_distinct_instance_items,
             1.0 / (1.0 + exp(-(8.19393897 - 0.54291739 * number_of_distinct_instance_items))) AS p_raw
      FROM study) t
GROUP BY number_of_distinct_instance_items, p_raw""", STUDY_CTE))
def q_logit_sigmoid(spark, sf):
    """Sigmoid of a one-feature model and its logit round trip."""
    s = prep.study_frame(att(spark, sf))
    eta = F.lit(8.19393897) - F.lit(0.54291739) * F.col("number_of_distinct_instance_items")
    s = s.select(F.col("number_of_distinct_instance_items").alias("items"), sigmoid(eta).alias("p"))
    return rounded(s.groupBy("items").agg(F.count(F.lit(1)).alias("n_rows"), F.max("p").alias("p"),
                                          F.max(logit(F.col("p"))).alias("log_odds")))


# ------------------------------------------------------------ N: evaluation

@query("confusion", with_attempts("""
SELECT 0 AS label, 0 AS prediction, tn AS count FROM cnt UNION ALL SELECT 0, 1, fp FROM cnt
UNION ALL SELECT 1, 0, fn FROM cnt UNION ALL SELECT 1, 1, tp FROM cnt""", *_EVAL, _CNT))
def q_confusion(spark, sf):
    """Dense confusion matrix."""
    return evaluate.confusion_matrix(_scored(spark, sf))


@query("accuracy", with_attempts("""
SELECT round((tp + tn) * 1.0 / (tp + fp + tn + fn), 6) AS accuracy FROM cnt""", *_EVAL, _CNT))
def q_accuracy(spark, sf):
    """N2."""
    return rounded(evaluate.binary_metrics(_scored(spark, sf)).select("accuracy"))


@query("precision_recall", with_attempts("""
SELECT tp, fp, tn, fn, round(coalesce(tp * 1.0 / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp * 1.0 / nullif(tp + fn, 0), 0), 6) AS recall FROM cnt""", *_EVAL, _CNT))
def q_precision_recall(spark, sf):
    """N3/N4."""
    return rounded(evaluate.binary_metrics(_scored(spark, sf)).drop("accuracy"))


_ROC_CTES = _EVAL + [
    """g AS (SELECT score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM scp
         WHERE score IS NOT NULL GROUP BY score)""",
    "tt AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g)",
    """cu AS (SELECT score, pos, neg,
          sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
          sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn FROM g)"""]


@query("roc_curve", with_attempts("""
SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL SELECT round(score, 6), round(cn * 1.0 / N, 6), round(cp * 1.0 / P, 6) FROM cu, tt""", *_ROC_CTES))
def q_roc_curve(spark, sf):
    """Every distinct threshold (collinear points kept), cumulative counts
    by range-partitioned windows."""
    return rounded(evaluate.roc_curve(_scored(spark, sf), "label", "score"))


@query("roc_corners", with_attempts("""
SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL SELECT round(score, 6), round(cn * 1.0 / N, 6), round(cp * 1.0 / P, 6) FROM (
  SELECT *, lead(pos) OVER (ORDER BY score DESC) AS p2, lead(neg) OVER (ORDER BY score DESC) AS n2 FROM cu) t, tt
WHERE p2 IS NULL OR pos * n2 <> neg * p2""", *_ROC_CTES))
def q_roc_corners(spark, sf):
    """N5 without collinear points: only thresholds at which the curve turns."""
    return rounded(evaluate.roc_curve(_scored(spark, sf), "label", "score", drop_collinear=True))


@query("auc", with_attempts("""
SELECT round(sum(neg * (2.0 * cp - pos)) / (2.0 * max(P) * max(N)), 6) AS auc, CAST(max(P) AS BIGINT) AS positives,
       CAST(max(N) AS BIGINT) AS negatives FROM cu, tt""", *_ROC_CTES))
def q_auc(spark, sf):
    """Trapezoid AUC."""
    return rounded(evaluate.auc(_scored(spark, sf), "label", "score"))


@query("auc_hard", with_attempts("""
SELECT round(sum(neg * (2.0 * cp - pos)) / (2.0 * max(P) * max(N)), 6) AS auc, CAST(max(P) AS BIGINT) AS positives,
       CAST(max(N) AS BIGINT) AS negatives
FROM (SELECT prediction, pos, neg,
        sum(pos) OVER (ORDER BY prediction DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp
      FROM (SELECT CAST(prediction AS DOUBLE) AS prediction, count_if(label = 1) AS pos, count_if(label <> 1) AS neg
            FROM scp GROUP BY 1) h) c,
     (SELECT count_if(label = 1) AS P, count_if(label <> 1) AS N FROM scp) t""", *_EVAL))
def q_auc_hard(spark, sf):
    """AUC of the hard class (balanced accuracy)."""
    return rounded(evaluate.auc_hard(_scored(spark, sf), "label", "prediction"))


@query("classification_report", with_attempts("""
SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0 AS support FROM m
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, round(acc, 6), s0 + s1 FROM m
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), s0 + s1 FROM m
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6), round((r0 * s0 + r1 * s1) / (s0 + s1), 6),
                 round((f0 * s0 + f1 * s1) / (s0 + s1), 6), s0 + s1 FROM m""", *_EVAL, _CNT, """m0 AS (
  SELECT CAST(tp + fn AS DOUBLE) AS s1, CAST(tn + fp AS DOUBLE) AS s0, (tp + tn) * 1.0 / (tp + fp + tn + fn) AS acc,
         coalesce(tp * 1.0 / nullif(tp + fp, 0), 0) AS p1, coalesce(tp * 1.0 / nullif(tp + fn, 0), 0) AS r1,
         coalesce(tn * 1.0 / nullif(tn + fn, 0), 0) AS p0, coalesce(tn * 1.0 / nullif(tn + fp, 0), 0) AS r0 FROM cnt)""",
    """m AS (SELECT *, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1,
                  coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0 FROM m0)"""))
def q_classification_report(spark, sf):
    """Per-class precision/recall/f1/support, accuracy, macro and weighted averages."""
    return rounded(evaluate.classification_report(_scored(spark, sf)))


# ---------------------------------------------------------------- M: models

def _model_data(spark, sf):
    return prep.model_frame(att(spark, sf), "train")


@query("logit_inference")
def q_logit_inference(spark, sf):
    """M1/M9: ML logistic regression with intercept: coefficient table
    (estimate, standard error, z, p, 95 % interval)."""
    fit = model.logit_fit(_model_data(spark, sf), prep.MODEL_FEATURES, "target", intercept=True)
    return fit.coef_frame(spark)


@query("logit_model_stats")
def q_logit_model_stats(spark, sf):
    """N, log-likelihood, null LL, AIC, BIC, McFadden pseudo-R2."""
    fit = model.logit_fit(_model_data(spark, sf), prep.MODEL_FEATURES, "target", intercept=True)
    return fit.stats_frame(spark)


@query("logit_no_intercept")
def q_logit_no_intercept(spark, sf):
    """M2: the same model without intercept."""
    fit = model.logit_fit(_model_data(spark, sf), prep.MODEL_FEATURES, "target", intercept=False)
    return fit.coef_frame(spark)


@query("logit_l2")
def q_logit_l2(spark, sf):
    """M3: L2-regularised logistic regression (C = 1)."""
    _, table = model.logit_l2(_model_data(spark, sf), prep.MODEL_FEATURES, "target", C=1.0)
    return table


@query("coef_table")
def q_coef_table(spark, sf):
    """M9: (param, estimate) of the ML fit scored back on the validation split (M4)."""
    fit = model.logit_fit(_model_data(spark, sf), prep.MODEL_FEATURES, "target")
    coefs = {t: float(b) for t, b in zip(fit.terms, fit.coef) if t != model.INTERCEPT}
    valid = prep.model_frame(att(spark, sf), "valid")
    scored = model.classify(model.score_by_coefficients(valid, coefs, float(fit.coef[0])))
    m = evaluate.binary_metrics(scored.withColumnRenamed("target", "label"))
    return (
        fit.coef_frame(spark).select(F.col("term").alias("param"), "estimate").unionByName(
            m.select(F.lit("validation_accuracy").alias("param"), F.col("accuracy").alias("estimate"))))


@query("ols_one", """
SELECT 'intercept' AS term, round(regr_intercept(l_extendedprice, l_quantity), 6) AS estimate FROM lineitem
UNION ALL SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 6) FROM lineitem
UNION ALL SELECT 'r_squared', round(regr_r2(l_extendedprice, l_quantity), 6) FROM lineitem""")
def q_ols_one(spark, sf):
    """M5 with one regressor: Gram-matrix OLS equals the SQL regression aggregates."""
    fit = model.ols_fit(tbl(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice")
    rows = [(t, float(b)) for t, b in zip(fit.terms, fit.coef)] + [("r_squared", float(fit.r2))]
    return rounded(spark.createDataFrame(rows, "term string, estimate double"))


@query("ols_inference")
def q_ols_inference(spark, sf):
    """M5: OLS with standard errors, t, p and intervals from one Gram pass."""
    fit = model.ols_fit(tbl(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return fit.coef_frame(spark).unionByName(
        fit.stats_frame(spark).select(F.col("statistic").alias("term"), F.col("value").alias("estimate")), allowMissingColumns=True)


_STEP_COLS = ["student_duration_mins", "timeliness_duration_mins", "item_attempt_duration_mins",
              "item_type_code_name_swoe", "number_of_distinct_instance_items"]


@query("stepwise_forward")
def q_stepwise_forward(spark, sf):
    """Forward selection, logistic, AIC, sl = 0.05 (selection log)."""
    sel = stepwise.forward_selection(_model_data(spark, sf), _STEP_COLS, "target", "logistic", "aic", 0.05)
    return sel.log_frame(spark)


@query("stepwise_backward")
def q_stepwise_backward(spark, sf):
    """Backward elimination with regain, logistic, AIC."""
    sel = stepwise.backward_selection(_model_data(spark, sf), _STEP_COLS, "target", "logistic", "aic", 0.05)
    return sel.log_frame(spark)


@query("selection_log")
def q_selection_log(spark, sf):
    """M6/M10 linear: forward selection of the raw score on one Gram matrix
    (adjusted R2 criterion): the log followed by the final coefficient table."""
    s = prep.study_frame(att(spark, sf))
    cands = ["number_of_distinct_instance_items", "final_score_unweighted", "item_attempt_duration_mins",
             "number_of_learners"]
    sel = stepwise.forward_selection(s, cands, "raw_score", "linear", "adjr2", 0.05)
    log = sel.log_frame(spark).select(F.concat(F.lit("step "), F.col("step").cast("string")).alias("item"),
                                      "action", "variable", "p_value", "criterion")
    coefs = sel.final.coef_frame(spark).select(F.lit("final").alias("item"), F.lit("coefficient").alias("action"),
                                               F.col("term").alias("variable"), "p_value",
                                               F.col("estimate").alias("criterion"))
    return log.unionByName(coefs)


@query("pca_variance")
def q_pca_variance(spark, sf):
    """M8: explained variance ratio and cumulative share of centred columns."""
    t, _ = model.pca_variance(tbl(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return t


# ------------------------------------------------------ labelled documents

def _labelled(spark, sf):
    """labels joined to the documents' size and language (text column pruned)."""
    docs = tbl(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    lab = tbl(spark, sf, "labels")
    return lab.join(docs, "doc_id").withColumn("log_chars", F.log1p(F.col("n_chars").cast("double")))


@query("labels_stratified_split", """
SELECT quality, CASE WHEN rn <= floor(0.75 * n) THEN 'train' ELSE 'valid' END AS split, count(*) AS n_rows
FROM (SELECT quality, row_number() OVER (PARTITION BY quality ORDER BY
               CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT)) AS rn,
             count(*) OVER (PARTITION BY quality) AS n
      FROM labels) t
GROUP BY 1, 2""")
def q_labels_stratified_split(spark, sf):
    """S3 on the labels table: exact per-class 75/25 split by document hash."""
    from scorecraft.operators import split
    s = split.stratified_split(tbl(spark, sf, "labels"), "quality", ["doc_id"])
    return s.groupBy("quality", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@query("logit_labels")
def q_logit_labels(spark, sf):
    """M1 on labelled documents: quality ~ log length + toxic, with inference."""
    return model.logit_fit(_labelled(spark, sf), ["log_chars", "toxic"], "quality").coef_frame(spark)


@query("labels_woe", """
WITH d AS (SELECT l.quality, CAST(doc.lang AS VARCHAR) AS category FROM labels l JOIN documents doc ON l.doc_id = doc.doc_id),
c AS (SELECT category, count_if(quality = 1) AS n_good, count_if(quality <> 1) AS n_bad FROM d GROUP BY category),
t AS (SELECT sum(n_good) AS tg, sum(n_bad) AS tb FROM c)
SELECT 'lang' AS variable, category, n_good, n_bad,
       round((CASE WHEN category IS NULL OR n_good = 0 THEN 0.5 ELSE n_good END) / tg, 6) AS good_dist,
       round((CASE WHEN category IS NULL OR n_bad = 0 THEN 0.5 ELSE n_bad END) / tb, 6) AS bad_dist,
       round(ln(((CASE WHEN category IS NULL OR n_good = 0 THEN 0.5 ELSE n_good END) / tg)
              / ((CASE WHEN category IS NULL OR n_bad = 0 THEN 0.5 ELSE n_bad END) / tb)), 6) AS woe,
       round((((CASE WHEN category IS NULL OR n_good = 0 THEN 0.5 ELSE n_good END) / tg)
              - ((CASE WHEN category IS NULL OR n_bad = 0 THEN 0.5 ELSE n_bad END) / tb))
             * ln(((CASE WHEN category IS NULL OR n_good = 0 THEN 0.5 ELSE n_good END) / tg)
              / ((CASE WHEN category IS NULL OR n_bad = 0 THEN 0.5 ELSE n_bad END) / tb)), 6) AS iv
FROM c, t""")
def q_labels_woe(spark, sf):
    """L1 on labelled documents: WOE/IV of the language for the quality label."""
    from scorecraft.operators import encode
    d = _labelled(spark, sf).select("quality", "lang")
    return rounded(encode.woe_table(d, ["lang"], "quality", 1))
