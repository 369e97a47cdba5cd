"""Reconciliation checks over result tables; each check is one row.

Result columns: ``check, passed, severity, detail``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.params import ValidationSettings

V = ValidationSettings()


def _check(name: str, passed: Column, detail: Column, severity: str = "error") -> list[Column]:
    return [F.lit(name).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"),
            F.lit(severity).alias("severity"), detail.alias("detail")]


def _text(*parts) -> Column:
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("none")) if isinstance(p, Column)
                      else F.lit(str(p)) for p in parts])


def _coverage(stage: int) -> Column:
    return F.max(F.when(F.col("stage") == stage, F.col("coverage_pct"))).alias(f"s{stage}")


def coverage_rises_by_stage(summary: DataFrame) -> DataFrame:
    """``summary`` has one row per stage with ``coverage_pct``; a missing stage does not fail."""
    by = summary.agg(_coverage(1), _coverage(2), _coverage(3))
    one, two = F.coalesce("s1", F.lit(0.0)), F.coalesce("s2", F.lit(0.0))
    three = F.coalesce("s3", F.lit(1e9))
    return by.select(*_check("coverage_monotonic_by_stage", (one <= two) & (two <= three),
                             _text("stages ", F.round("s1", 3), ", ", F.round("s2", 3), ", ",
                                   F.round("s3", 3), " %")))


def stage3_matches_severity(summary: DataFrame, weighted_lgd: float,
                            tolerance: float = V.stage3_tolerance_pct) -> DataFrame:
    by = summary.agg(_coverage(3))
    return by.select(*_check(
        "stage3_equals_weighted_lgd", F.abs(F.col("s3") - weighted_lgd * 100) <= tolerance,
        _text("stage 3 coverage ", F.round("s3", 3), " %, weighted severity ",
              round(weighted_lgd * 100, 3), " %")))


def coverage_in_range(summary: DataFrame, limits: tuple = V.coverage_range_pct) -> DataFrame:
    """Uses the portfolio row (null stage) of the summary."""
    total = summary.filter(F.col("stage").isNull()).agg(F.max("coverage_pct").alias("c"))
    return total.select(*_check("portfolio_coverage_in_range", F.col("c").between(*limits),
                                _text("coverage ", F.round("c", 4), " % in ", limits)))


def scenario_order(ordering: DataFrame) -> DataFrame:
    return ordering.agg(F.bool_and("ordering_ok").alias("ok")).select(
        *_check("scenario_pd_ordering", F.col("ok"), _text("downside >= base >= upside: ",
                                                           F.col("ok"))))


def discrimination(metrics: DataFrame, min_auc: float = V.min_auc) -> DataFrame:
    """``metrics`` has one row per model with ``auc``."""
    best = metrics.agg(F.max("auc").alias("auc"), F.max_by("model", "auc").alias("model"))
    return best.select(*_check("pd_discrimination_auc", F.col("auc") >= min_auc,
                               _text("best model ", F.col("model"), " AUC ",
                                     F.round("auc", 4), " >= ", min_auc)))


def effective_calibration(book: DataFrame, ttc_pd: Column | float,
                          band: tuple = V.calibration_band) -> DataFrame:
    """Mean current PD of the book against the long-run rate."""
    ttc = ttc_pd if isinstance(ttc_pd, Column) else F.lit(float(ttc_pd))
    ratio = book.agg(F.avg("pd_now").alias("pd")).withColumn(
        "ratio", F.col("pd") / F.greatest(ttc, F.lit(1e-9)))
    return ratio.select(*_check("effective_pd_calibration", F.col("ratio").between(*band),
                                _text("portfolio PD ", F.round("pd", 4), ", ratio ",
                                      F.round("ratio", 2), " in ", band)))


def raw_calibration(calibration: DataFrame, band: tuple = V.calibration_band) -> DataFrame:
    """Advisory: row-weighted predicted over observed rate of the raw scores."""
    sums = calibration.agg(F.sum("n").alias("n"),
                           F.sum(F.col("pred_pd") * F.col("n")).alias("p"),
                           F.sum(F.col("obs_default") * F.col("n")).alias("o"))
    n = F.greatest("n", F.lit(1))
    ratio = sums.withColumn("ratio", (F.col("p") / n) / F.greatest(F.col("o") / n, F.lit(1e-9)))
    return ratio.select(*_check(
        "pd_calibration_band_raw", F.col("n").isNull() | F.col("ratio").between(*band),
        _text("raw predicted/observed ratio ", F.round("ratio", 3)), "warn"))


def all_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def tally(checks: DataFrame) -> DataFrame:
    """Headline counts: only error-level checks are scored, advisories are counted."""
    is_error = F.col("severity") == "error"
    return checks.agg(F.count_if(is_error & F.col("passed")).alias("n_error_passed"),
                      F.count_if(is_error).alias("n_error_checks"),
                      F.count_if(F.col("severity") == "warn").alias("n_advisory"))
