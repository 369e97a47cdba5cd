"""The window orders used everywhere (functions, because a window needs a running session)."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import WindowSpec


def by_loan(*placed: str) -> WindowSpec:
    """Rows of a loan in time order. A loan has at most one row per calendar month (the table key),
    so a window partition is bounded by the calendar, not by the data volume. Columns ``placed`` have one
    value per loan: rows that lie in ranges over them and the loan are not shuffled again."""
    return W.partitionBy(*placed, "loan_id").orderBy("reporting_period")


def whole_loan() -> WindowSpec:
    """All rows of the loan, in the same order, so that it shares the sort of :func:`by_loan`."""
    return by_loan().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)


def by_month(month: str = "reporting_period") -> WindowSpec:
    """Order of a table with one row per calendar month (bounded by the calendar)."""
    return W.partitionBy().orderBy(month)
