"""Invariants from the study's own checks and streaming restarts."""

import os
import tempfile

from pyspark.sql import functions as F

from scorecraft.operators import clean, distribution, impute
from scorecraft.plans.catalog import att, att_path
from scorecraft.plans.prep import study_frame
from scorecraft.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_removed_equals_slice(spark):
    a = clean.keep_scored(att(spark, SF))
    c = F.col("response_correctness")
    loss = clean.row_loss(a, c.isNull() | (c != clean.UNASSIGNED)).first()
    assert loss["removed"] == a.where(c == clean.UNASSIGNED).count()
    assert loss["kept"] == clean.drop_value_keep_null(a, "response_correctness").count()


def test_imputed_values_stay_under_fence(spark):
    s = study_frame(att(spark, SF))
    cols = ["item_attempt_duration_mins", "student_duration_mins"]
    fences = distribution.fence_values(s, cols)
    out = impute.iqr_impute(s, cols)
    mx = out.agg(*[F.max(c).alias(c) for c in cols]).first()
    for c in cols:
        assert mx[c] <= fences[c][1]
        assert out.where(F.col(c + "_imputed")).count() == s.where(F.col(c) > fences[c][1]).count()


def test_stream_restart_is_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="scorecraft-stream-")
    sink, ck = os.path.join(base, "sink"), os.path.join(base, "ck")
    first = ingest.clean_stream(spark, att_path(spark, SF), sink, ck).count()
    again = ingest.clean_stream(spark, att_path(spark, SF), sink, ck).count()  # restart: nothing new
    assert first == again == study_frame(att(spark, SF)).count()
