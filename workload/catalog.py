"""All registered queries."""

from __future__ import annotations

from workload import (  # noqa: F401
    q_cohort,
    q_data,
    q_models,
    q_order,
    q_oversight,
    q_quality,
    q_risk,
)
from workload.registry import ORACLE, QUERIES

FLAGSHIP = "a19_loss_summary"

__all__ = ["FLAGSHIP", "ORACLE", "QUERIES"]
