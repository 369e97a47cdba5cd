"""The whole data-quality suite over both loan tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from lossloom import schema
from lossloom.operators import drift, quality
from lossloom.params import QualityLimits
from lossloom.sources.results import Results, quality_rows
from lossloom.sources.warehouse import Warehouse

MONTHLY_COLUMNS = ["loan_id", "reporting_period", "upb_current", "delq_status", "loan_age",
                   "total_principal_current"]


def quality_suite(master: DataFrame, monthly: DataFrame, q: QualityLimits = QualityLimits(),
                  expected: list[str] | None = None) -> DataFrame:
    """All check rows; only the monthly columns that are checked are read.

    The checks of one pass are taken while the other checks' few columns are stored, so each table
    is read and derived once.
    """
    expected = expected or schema.LOAN_MASTER.names
    keys = [c for c in ("loan_id", "vintage", *q.outlier_columns, *q.drift_features)
            if c in master.columns]
    loans, found = quality.master_pass(master, expected, q).while_storing(
        master, list(dict.fromkeys(keys)))
    monthly = monthly.select(*[c for c in MONTHLY_COLUMNS if c in monthly.columns])
    months, more = quality.monthly_pass(monthly, q).while_storing(
        monthly, [c for c in ("loan_id", "reporting_period") if c in monthly.columns])
    return reduce(DataFrame.unionByName, [
        found, more,
        quality.duplicate_check(loans, "loan_master", ["loan_id"]),
        quality.outlier_check(loans, "loan_master", list(q.outlier_columns)),
        quality.duplicate_check(months, "loan_monthly", ["loan_id", "reporting_period"]),
        drift.coverage_check(loans),
        drift.drift_checks(loans, q),
    ])


def run(store: Warehouse, results: Results, run_id: str,
        q: QualityLimits = QualityLimits()) -> DataFrame:
    """Check the stored tables, append the rows to ``dq_results`` and return the scorecard."""
    rows = quality_suite(store.read("loan_master"), store.read("loan_monthly"), q)
    results.append(quality_rows(rows, run_id), "dq_results")
    return quality.scorecard(rows)
