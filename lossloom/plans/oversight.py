"""Validation and monitoring stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.operators import drift, labels, loss, monitoring, validation
from lossloom.operators.durable import durable
from lossloom.operators.models import Scorer
from lossloom.params import LossSettings, MonitoringSettings, PdSettings, ValidationSettings
from lossloom.plans.risk import BookLoss
from lossloom.sources.results import Results


def validation_stage(book: BookLoss, staged: DataFrame, paths: DataFrame, ordering: DataFrame,
                     metrics: DataFrame, calibration: DataFrame, ttc_pd: float,
                     weights: dict[str, float], base_lgd: float, downturn_lgd: float,
                     s: LossSettings = LossSettings(),
                     v: ValidationSettings = ValidationSettings(),
                     results: Results | None = None) -> tuple[DataFrame, DataFrame]:
    """Check rows and the sensitivity grid of the book."""
    checks = durable(validation.all_checks(
        validation.coverage_rises_by_stage(book.summary),
        validation.stage3_matches_severity(book.summary, book.case.weighted_lgd,
                                           v.stage3_tolerance_pct),
        validation.coverage_in_range(book.summary, v.coverage_range_pct),
        validation.scenario_order(ordering),
        validation.discrimination(metrics, v.min_auc),
        validation.raw_calibration(calibration, v.calibration_band),
        validation.effective_calibration(staged, ttc_pd, v.calibration_band)))
    grid = durable(loss.sensitivity_grid(book.loans, loss.sensitivity_cases(
        loss.collect_paths(paths), weights, base_lgd, downturn_lgd, s, v)))
    if results is not None:
        results.replace(checks, "validation_checks")
        results.replace(validation.tally(checks), "validation_tally")
        results.replace(grid, "sensitivity")
        psi = drift.stability_of_two(staged, "pd_orig", "pd_now").select("psi").scalar()
        results.replace(staged.agg(F.avg("pd_now").alias("calibrated_portfolio_pd")).withColumn(
            "pd_migration_psi", psi), "validation_run")
    return checks, grid


def backtest_panel(features: DataFrame, scorer: Scorer,
                   s: PdSettings = PdSettings()) -> DataFrame:
    """Performing months with a fully observed outcome, the predicted PD and the quarter."""
    closed = labels.drop_open_window(labels.label_defaults(features, s.horizon, s.default_dpd),
                                     s.horizon)
    scored = scorer(closed).withColumnRenamed("pd", "pred_pd")
    return monitoring.with_quarter(scored).select("period", "reporting_period", "pred_pd",
                                                  "target", "delq_num")


def monitoring_stage(features: DataFrame, scorer: Scorer, s: PdSettings = PdSettings(),
                     m: MonitoringSettings = MonitoringSettings(),
                     results: Results | None = None) -> DataFrame:
    """Latest and worst status, one row; the panel is scored once for both measures."""
    panel = durable(backtest_panel(features, scorer, s))
    back = durable(monitoring.backtest(panel, m))
    psi = durable(monitoring.score_stability(panel, m))
    lights = monitoring.lights(back, psi)
    status = monitoring.status(lights)
    if results is not None:
        results.replace(status, "monitoring_status")
        results.replace(monitoring.breaches(lights), "monitoring_breaches")
        results.replace(back, "monitoring_backtest")
        results.replace(psi, "monitoring_psi")
        results.replace(monitoring.delinquency_trend(
            monitoring.delinquency_panel(features), m), "monitoring_delinquency")
    return status
