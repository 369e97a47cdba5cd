"""Null-preserving limits (``least``/``greatest`` alone would turn a null into the limit)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(c: Column, low: float, high: float) -> Column:
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(low))), F.lit(float(high))))


def no_nan(c: str | Column) -> Column:
    """NaN becomes null, the only missing value used here."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)
