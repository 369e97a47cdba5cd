"""Severity, exposure, staging, scenario and loss stages over stored tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.operators import exposure, loss, regression, scenarios, severity, staging
from lossloom.operators.durable import durable
from lossloom.operators.macro import latest_values
from lossloom.operators.models import Scorer
from lossloom.operators.regression import LinearFit
from lossloom.params import (
    EadSettings,
    LgdSettings,
    LossSettings,
    ScenarioSettings,
    StagingSettings,
)
from lossloom.sources.results import Results


def severity_stage(monthly: DataFrame, master: DataFrame, macro: DataFrame,
                   s: LgdSettings = LgdSettings(),
                   results: Results | None = None) -> tuple[DataFrame, DataFrame, LinearFit]:
    """Statistics and downturn level (one row each) and the fitted severity model."""
    events = severity.dispositions(monthly, master)
    losses = durable(severity.with_current_ltv(severity.with_severity(events), macro))
    filled, kept = regression.impute_medians(losses, list(s.features))
    filled = durable(filled)
    fit = regression.fit_linear(filled, kept, "lgd", min_rows=2)
    worst = durable(severity.worst_window(filled, s.window_months, s.min_obs))
    stats = durable(severity.severity_statistics(filled))
    downturn = durable(severity.downturn_severity(filled, fit, worst, s))
    if results is not None:
        results.replace(stats, "lgd_stats")
        results.replace(severity.severity_by_bucket(filled, s.buckets), "lgd_buckets")
        results.replace(worst, "lgd_window")
        results.replace(downturn, "lgd_downturn")
        results.replace(fit.table(monthly.sparkSession), "lgd_fit")
    return stats, downturn, fit


def exposure_stage(monthly: DataFrame, s: EadSettings = EadSettings(),
                   results: Results | None = None) -> DataFrame:
    """Back-test of the amortisation schedule (all loans unless ``sample_mod`` thins them)."""
    backtest = durable(exposure.schedule_backtest(
        exposure.exposure_panel(monthly, s.sample_mod), s.horizons))
    if results is not None:
        results.replace(backtest, "ead_backtest")
        results.replace(exposure.curtailment_factor(backtest).withColumn(
            "apply_curtailment", F.lit(s.apply_curtailment)), "ead")
    return backtest


def staged_book(features: DataFrame, columns: list[str], scorer: Scorer,
                period: str | None = None, s: StagingSettings = StagingSettings()) -> DataFrame:
    return staging.with_stage(staging.staged_inputs(features, columns, scorer, period), s)


def staging_stage(features: DataFrame, columns: list[str], scorer: Scorer,
                  period: str | None = None, s: StagingSettings = StagingSettings(),
                  migration: tuple[str, str] | None = None,
                  results: Results | None = None) -> DataFrame:
    """Staged book; optionally also the migration between two earlier months."""
    staged = durable(staged_book(features, columns, scorer, period, s))
    if results is not None:
        results.replace(staging.stage_distribution(staged), "stages")
        results.replace(staging.trigger_counts(staged), "stage_triggers")
        if migration:
            before, after = (staged_book(features, columns, scorer, day, s) for day in migration)
            results.replace(staging.migration_matrix(before, after), "stage_migration")
    return staged


@dataclass
class ScenarioSet:
    paths: DataFrame  # scenario, weight, month, z, pit_pd
    adjusted: bool
    ordering: DataFrame


def scenario_stage(macro: DataFrame, fit: LinearFit, ttc_pd: float, rho: float,
                   s: ScenarioSettings = ScenarioSettings(),
                   results: Results | None = None) -> ScenarioSet:
    paths = scenarios.factor_paths(latest_values(macro, list(fit.features)), fit, s)
    adjusted = False
    if s.enforce_monotonic:
        clamped = durable(scenarios.ordered_factors(paths))
        adjusted = bool(clamped.agg(F.bool_or("adjusted")).first()[0])
        paths = clamped.drop("adjusted")
    paths = durable(scenarios.default_paths(paths, F.lit(float(ttc_pd)), rho))
    ordering = scenarios.ordering_check(paths)
    if results is not None:
        results.replace(paths, "scenario_paths")
        results.replace(ordering.withColumn("monotonic_adjusted", F.lit(adjusted)),
                        "scenario_ordering")
    return ScenarioSet(paths, adjusted, ordering)


@dataclass
class BookLoss:
    loans: DataFrame
    summary: DataFrame
    case: loss.LossCase


def loss_stage(staged: DataFrame, monthly: DataFrame, paths: DataFrame, weights: dict[str, float],
               base_lgd: float, downturn_lgd: float, period: str | None = None,
               s: LossSettings = LossSettings(), results: Results | None = None) -> BookLoss:
    """Expected loss of the book: per loan (not stored unless asked) and by stage."""
    loans = loss.attach_exposure(staged, exposure.latest_exposure(monthly, period))
    case = loss.loss_case("book", loss.collect_paths(paths), weights, base_lgd, downturn_lgd, s)
    summary = durable(loss.loss_summary(loss.loan_losses(loans, case)))
    if results is not None:
        spark = staged.sparkSession
        results.replace(summary, "ecl_summary")
        results.replace(spark.createDataFrame(list(case.lgd.items()),
                                              "scenario string, lgd double"), "ecl_lgd")
        results.replace(spark.createDataFrame(
            [(period or "latest", case.horizon, s.annual_cpr, case.weighted_lgd)],
            "reporting_period string, horizon_months int, annual_cpr double, "
            "weighted_lgd double"), "ecl_run")
    return BookLoss(loans, summary, case)
