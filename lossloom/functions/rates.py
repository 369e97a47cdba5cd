"""Conversions between annual and monthly rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bounds import clip


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _twelfth(p: Column) -> Column:
    return 1.0 - F.pow(1.0 - p, F.lit(1.0 / 12.0))


def monthly_hazard(annual_pd: str | Column) -> Column:
    """Constant monthly default hazard that compounds to a 12-month probability."""
    p = _col(annual_pd)
    return _twelfth(clip(p, 0.0, 0.999999))


def monthly_prepay(annual_cpr: str | Column) -> Column:
    """Single monthly mortality of an annual conditional prepayment rate."""
    return monthly_hazard(annual_cpr)


def monthly_prepay_value(annual_cpr: float) -> float:
    """The same conversion for a parameter."""
    return 1.0 - (1.0 - min(max(annual_cpr, 0.0), 0.999999)) ** (1.0 / 12.0)


def monthly_rate(annual_pct: str | Column) -> Column:
    return _col(annual_pct) / 100.0 / 12.0
