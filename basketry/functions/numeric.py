"""Numeric rules used across operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives zero where the denominator is zero."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; a constant becomes one half."""
    return F.when(high > low, (value - low) / (high - low)).otherwise(F.lit(0.5))


def f_beta(precision: Column, recall: Column, beta: float = 0.5) -> Column:
    b2 = beta * beta
    return F.coalesce(
        F.try_divide((1 + b2) * precision * recall, b2 * precision + recall), F.lit(0.0)
    )


def log_amount(value: Column) -> Column:
    """``log(1 + x)`` with negative amounts counted as zero."""
    return F.log1p(F.greatest(value, F.lit(0.0)))
