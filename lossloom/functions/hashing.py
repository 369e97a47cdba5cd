"""Sampling keys that do not depend on partitioning, retries or engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(c: str | Column, seed: int | None = None) -> Column:
    """Unsigned 32-bit number from the first eight hex digits of the MD5 of a key."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    if seed is not None:
        text = F.concat(text, F.lit(f"#{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def in_fraction(c: str | Column, fraction: float, seed: int | None = None) -> Column:
    """Keep about ``fraction`` of the distinct keys, each with all its rows."""
    return hash32(c, seed) % 1_000_000 < int(fraction * 1_000_000)


def one_in(c: str | Column, n: int) -> Column:
    """Keep one key in ``n``, each with all its rows."""
    return hash32(c) % n == 0
