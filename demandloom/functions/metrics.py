"""Forecast error measures as aggregate columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: keeps the weighted error defined when every actual is zero.
WMAPE_EPSILON = 1e-8


def _pair(actual: str | Column, predicted: str | Column) -> tuple[Column, Column]:
    as_column = lambda value: (F.col(value) if isinstance(value, str) else value).cast("double")
    return as_column(actual), as_column(predicted)


def rmse(actual: str | Column, predicted: str | Column) -> Column:
    y, p = _pair(actual, predicted)
    return F.sqrt(F.avg((y - p) * (y - p)))


def mae(actual: str | Column, predicted: str | Column) -> Column:
    y, p = _pair(actual, predicted)
    return F.avg(F.abs(y - p))


def wmape(actual: str | Column, predicted: str | Column) -> Column:
    y, p = _pair(actual, predicted)
    return F.sum(F.abs(y - p)) / (F.sum(F.abs(y)) + F.lit(WMAPE_EPSILON))


def bias(actual: str | Column, predicted: str | Column) -> Column:
    """Mean of actual minus predicted."""
    y, p = _pair(actual, predicted)
    return F.avg(y - p)


def r2(actual: str | Column, predicted: str | Column) -> Column:
    """One minus residual over total squares (not the squared correlation)."""
    y, p = _pair(actual, predicted)
    total = F.var_pop(y) * F.count(y)
    return F.lit(1.0) - F.try_divide(F.sum((y - p) * (y - p)), total)


def error_mean(actual: str | Column, predicted: str | Column) -> Column:
    return bias(actual, predicted)


def error_std(actual: str | Column, predicted: str | Column) -> Column:
    y, p = _pair(actual, predicted)
    return F.stddev_samp(y - p)


def improvement_pct(baseline: Column, model: Column) -> Column:
    """How much smaller the model's error is, in percent of the baseline's; null on a zero baseline."""
    return F.try_divide(baseline - model, baseline) * F.lit(100.0)
