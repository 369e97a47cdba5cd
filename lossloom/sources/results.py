"""Result tables of the stages, and the views that read them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossloom.sources.warehouse import Warehouse


class Results(Warehouse):
    """Each stage replaces its own result tables; readers get None for what is not there yet."""

    def get(self, table: str) -> DataFrame | None:
        return self.read(table) if self.exists(table) else None

    def save_json(self, df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").json(self.path(table) + ".json")


def quality_rows(results: DataFrame, run_id: str) -> DataFrame:
    """Check results in the shape of the ``dq_results`` table."""
    return results.withColumnsRenamed({"table": "table_name", "column": "column_name"}).select(
        F.lit(run_id).alias("run_id"), F.current_timestamp().alias("run_ts"), "table_name",
        "check_type", "column_name", "metric", "value", "threshold", "status", "message")


def _one(df: DataFrame | None, column: str, kind: str, where: Column | None = None) -> Column:
    """A single value of a small result table as a scalar subquery; null without the table."""
    if df is None or column not in df.columns:
        return F.lit(None).cast(kind)
    rows = df.filter(where) if where is not None else df
    return rows.agg(F.first(column, ignorenulls=True).cast(kind).alias(column)).scalar()


def _rows(df: DataFrame | None, *order: str) -> Column:
    """All rows of a small result table as an array of structs, empty without the table."""
    if df is None:
        return F.array()
    ordered = [*order, *[c for c in df.columns if c not in order]]
    return df.agg(F.sort_array(F.collect_list(F.struct(*ordered))).alias("rows")).scalar()


def _one_row(spark: SparkSession, **columns: Column) -> DataFrame:
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()])


def _status(monitoring: DataFrame | None, name: str) -> Column:
    """Older result tables have one ``overall_status`` instead of the two newer columns."""
    return F.coalesce(_one(monitoring, name, "string"), _one(monitoring, "overall_status", "string"))


def overview(spark: SparkSession, ecl: DataFrame | None = None, stages: DataFrame | None = None,
             monitoring: DataFrame | None = None, run: DataFrame | None = None) -> DataFrame:
    """Headline figures; whatever stage has not run shows as null."""
    total = F.col("stage").isNull()
    staged = (stages.agg(F.sum("n").alias("n")) if stages is not None else None)
    return _one_row(
        spark,
        total_ecl=_one(ecl, "ecl", "double", total), total_ead=_one(ecl, "ead", "double", total),
        coverage_pct=_one(ecl, "coverage_pct", "double", total),
        n_loans=F.coalesce(_one(ecl, "n_loans", "bigint", total), _one(staged, "n", "bigint")),
        weighted_lgd=_one(run, "weighted_lgd", "double"),
        reporting_period=_one(run, "reporting_period", "string"),
        monitoring_status=_status(monitoring, "latest_status"),
        stage_distribution=_rows(stages, "stage"))


def loss_view(spark: SparkSession, ecl: DataFrame | None,
              run: DataFrame | None = None, lgd: DataFrame | None = None) -> DataFrame | None:
    if ecl is None:
        return None
    total = F.col("stage").isNull()
    return _one_row(
        spark, total_ecl=_one(ecl, "ecl", "double", total),
        coverage_pct=_one(ecl, "coverage_pct", "double", total),
        by_stage=_rows(ecl.filter(~total), "stage"),
        weighted_lgd=_one(run, "weighted_lgd", "double"), lgd_by_scenario=_rows(lgd),
        ecl_12m_total=_one(ecl, "ecl_12m", "double", total),
        ecl_lifetime_total=_one(ecl, "ecl_lifetime", "double", total))


def scenario_view(spark: SparkSession, paths: DataFrame | None,
                  ordering: DataFrame | None = None) -> DataFrame | None:
    """``paths`` has ``scenario, weight, month, z, pit_pd``."""
    if paths is None:
        return None
    month = paths.agg(F.least(F.max("month"), F.lit(12)).alias("m")).scalar()
    at_12 = paths.filter(F.col("month") == month)
    weighted = paths.groupBy("month").agg(
        F.sum(F.col("weight") * F.col("pit_pd")).alias("weighted_pit_pd"))
    return _one_row(
        spark,
        at_12m=_rows(at_12.select("scenario", "weight", "z", "pit_pd"), "scenario"),
        weighted_pit_pd_12m=_one(weighted, "weighted_pit_pd", "double", F.col("month") == month),
        ordering_ok=_one(ordering, "ordering_ok", "boolean"),
        paths=_rows(paths.select("scenario", "month", "pit_pd"), "scenario", "month"),
        weighted_path=_rows(weighted, "month"),
        horizon_months=_one(paths.agg(F.max("month").alias("h")), "h", "int"))


def validation_view(spark: SparkSession, checks: DataFrame | None, tally: DataFrame | None = None,
                    metrics: DataFrame | None = None, sensitivity: DataFrame | None = None,
                    run: DataFrame | None = None) -> DataFrame | None:
    if checks is None:
        return None
    best = None if metrics is None else metrics.orderBy(F.desc("auc"), "model").limit(1)
    return _one_row(
        spark, checks=_rows(checks, "check"),
        n_error_passed=_one(tally, "n_error_passed", "bigint"),
        n_error_checks=_one(tally, "n_error_checks", "bigint"),
        n_advisory=_one(tally, "n_advisory", "bigint"),
        best_model=_one(best, "model", "string"), auc=_one(best, "auc", "double"),
        gini=_one(best, "gini", "double"), ks=_one(best, "ks", "double"),
        calibrated_portfolio_pd=_one(run, "calibrated_portfolio_pd", "double"),
        pd_migration_psi=_one(run, "pd_migration_psi", "double"),
        sensitivity=_rows(sensitivity, "position"))


def monitoring_view(spark: SparkSession, status: DataFrame | None,
                    breaches: DataFrame | None = None, backtest: DataFrame | None = None,
                    psi: DataFrame | None = None, trend: DataFrame | None = None
                    ) -> DataFrame | None:
    if status is None:
        return None
    return _one_row(
        spark, latest_status=_status(status, "latest_status"),
        historical_worst=_status(status, "historical_worst"),
        red=_one(breaches, "red", "bigint"), amber=_one(breaches, "amber", "bigint"),
        green=_one(breaches, "green", "bigint"), backtest=_rows(backtest, "period"),
        psi=_rows(psi, "to"), delinquency_trend=_rows(trend, "period"))


def model_view(spark: SparkSession, metrics: DataFrame | None = None,
               iv: DataFrame | None = None, calibration: DataFrame | None = None,
               roc: DataFrame | None = None, ks: DataFrame | None = None,
               lgd: DataFrame | None = None, downturn: DataFrame | None = None,
               window: DataFrame | None = None, fit: DataFrame | None = None,
               ead: DataFrame | None = None, pit: DataFrame | None = None) -> DataFrame:
    """Figures of every fitted model in one row; missing parts are null or empty."""
    best = None if metrics is None else metrics.orderBy(F.desc("auc"), "model").limit(1)
    start = _one(window, "window_start", "date")
    label = F.when(start.isNotNull(), F.concat(
        F.date_format(start, "yyyy-MM"), F.lit(" – "),
        F.date_format(_one(window, "window_end", "date"), "yyyy-MM")))
    return _one_row(
        spark,
        pd_best_model=_one(best, "model", "string"), pd_auc=_one(best, "auc", "double"),
        pd_gini=_one(best, "gini", "double"), pd_ks=_one(best, "ks", "double"),
        pd_models=_rows(metrics, "model"), pd_iv=_rows(iv, "feature"),
        pd_calibration=_rows(calibration, "bin"), pd_roc=_rows(roc, "position"),
        pd_ks_curve=_rows(ks, "pop_pct"),
        lgd_mean=_one(lgd, "mean", "double"), lgd_n=_one(lgd, "n", "bigint"),
        lgd_downturn=_one(downturn, "downturn_lgd", "double"),
        lgd_uplift=_one(downturn, "uplift_ratio", "double"),
        lgd_driver=_one(downturn, "driver", "string"),
        lgd_empirical_lgd=_one(downturn, "empirical_lgd", "double"), lgd_window=label,
        lgd_fit_r2=_one(fit, "r2", "double"),
        ead_method=F.lit(None if ead is None else "scheduled_amortization"),
        ead_curtailment_12m=_one(ead, "curtailment_factor", "double"),
        ead_apply_curtailment=_one(ead, "apply_curtailment", "boolean"),
        ttc_pd=_one(pit, "ttc_pd", "double"),
        asset_correlation=_one(pit, "asset_correlation", "double"))
