"""Level-payment annuities as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rates import monthly_rate


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else (c if isinstance(c, Column) else F.lit(float(c)))


def monthly_payment(balance, annual_pct, months) -> Column:
    """Level payment that clears ``balance`` in ``months``; 0 for empty loans."""
    b, n = _col(balance), _col(months)
    r = monthly_rate(_col(annual_pct))
    return (
        F.when((b <= 0) | (n <= 0), F.lit(0.0))
        .when(F.abs(r) < 1e-9, F.try_divide(b, n))
        .otherwise(F.try_divide(b * r, 1 - F.pow(1 + r, -n)))
    )


def remaining_balance(balance, annual_pct, months, paid) -> Column:
    """Balance left after ``paid`` of ``months`` level payments (never below zero)."""
    b, n = _col(balance), _col(months)
    k = F.least(_col(paid), n)
    growth = monthly_growth(_col(annual_pct))
    return not_below_zero(unpaid(b, _col(annual_pct), n, k, F.pow(growth, n), F.pow(growth, k)))


def monthly_growth(annual_pct) -> Column:
    return 1 + monthly_rate(_col(annual_pct))


def unpaid(b: Column, annual_pct: Column, n: Column, k: Column, full: Column, part: Column) -> Column:
    """The balance after ``k`` of ``n`` payments from the growth over both, for callers that keep these
    powers in columns: an expression would take each of them several times per row."""
    return (
        F.when((b <= 0) | (n <= 0), F.lit(0.0))
        .when(F.abs(monthly_rate(annual_pct)) < 1e-9, F.try_divide(b * (n - k), n))
        .when(F.abs(full - 1) >= 1e-12, F.try_divide(b * (full - part), full - 1))
    )


def not_below_zero(left: Column) -> Column:
    return F.when(left.isNotNull(), F.greatest(left, F.lit(0.0)))


def balance_path(balance, annual_pct, months, horizon: int, scale: float = 1.0) -> Column:
    """Array of the balances after 1..horizon payments, optionally scaled for curtailment."""
    b, r, n = _col(balance), _col(annual_pct), _col(months)
    return F.array(*[remaining_balance(b, r, n, F.lit(float(k))) * scale
                     for k in range(1, horizon + 1)])
