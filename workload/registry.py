"""Registered queries and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, text: str | None = None):
    """Register ``fn(spark, sf_dir)``; ``text`` may use the named parts of :mod:`workload.sql`."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if text is not None:
            ORACLE[name] = sql.with_parts(text)
        return fn
    return register
