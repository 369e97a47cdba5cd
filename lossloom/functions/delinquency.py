"""Reading the delinquency status and exit codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def months_past_due(status: str | Column) -> Column:
    """Integer months past due; non-numeric status such as ``XX`` is unknown (null)."""
    c = F.col(status) if isinstance(status, str) else status
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))


def at_least(status: str | Column, months: int) -> Column:
    """True when the status is known and at least ``months``; unknown counts as false."""
    return F.coalesce(months_past_due(status) >= months, F.lit(False))


def code_in(code: str | Column, codes: Sequence[str]) -> Column:
    """Exit code membership, ignoring padding blanks."""
    c = F.col(code) if isinstance(code, str) else code
    return F.trim(c.cast("string")).isin(*codes)


def usable_balance(balance: str | Column) -> Column:
    """Balances at or below zero mean "not yet reported"."""
    c = F.col(balance) if isinstance(balance, str) else balance
    return F.when(c > 0, c)
