"""Inverse normal distribution as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Acklam's rational approximation (relative error below 1.2e-9).
CENTRE_NUM = (
    -3.969683028665376e01,
    2.209460984245205e02,
    -2.759285104469687e02,
    1.383577518672690e02,
    -3.066479806614716e01,
    2.506628277459239e00,
)
CENTRE_DEN = (
    -5.447609879822406e01,
    1.615858368580409e02,
    -1.556989798598866e02,
    6.680131188771972e01,
    -1.328068155288572e01,
    1.0,
)
TAIL_NUM = (
    -7.784894002430293e-03,
    -3.223964580411365e-01,
    -2.400758277161838e00,
    -2.549732539343734e00,
    4.374664141464968e00,
    2.938163982698783e00,
)
TAIL_DEN = (
    7.784695709041462e-03,
    3.224671290700398e-01,
    2.445134137142996e00,
    3.754408661907416e00,
    1.0,
)
TAIL = 0.02425


def _horner(coefficients, x: Column) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def normal_quantile(p: Column) -> Column:
    """Standard normal quantile of 0 < p < 1."""
    q = p - 0.5
    r = q * q
    centre = _horner(CENTRE_NUM, r) * q / _horner(CENTRE_DEN, r)
    low = F.sqrt(-2.0 * F.log(p))
    high = F.sqrt(-2.0 * F.log(1.0 - p))
    return (
        F.when((p <= 0) | (p >= 1), F.lit(None).cast("double"))
        .when(p < TAIL, _horner(TAIL_NUM, low) / _horner(TAIL_DEN, low))
        .when(p > 1 - TAIL, -_horner(TAIL_NUM, high) / _horner(TAIL_DEN, high))
        .otherwise(centre)
    )
