"""Logit and sigmoid as column expressions; M4 scoring by coefficients."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def logit(p: Column) -> Column:
    return F.ln(p / (F.lit(1.0) - p))


def linear_predictor(coefs: dict[str, float], intercept: float = 0.0) -> Column:
    expr = F.lit(float(intercept))
    for name, b in coefs.items():
        expr = expr + F.lit(float(b)) * F.col(name)
    return expr
