"""Period-over-period model monitoring with traffic lights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.functions.dates import quarter_start
from lossloom.operators.drift import stability
from lossloom.params import MonitoringSettings

M = MonitoringSettings()
TINY = 1e-6


def traffic_light(value: Column, amber: float, red: float) -> Column:
    return (F.when(value.isNull(), "n/a").when(value >= red, "RED")
            .when(value >= amber, "AMBER").otherwise("GREEN"))


def with_quarter(df: DataFrame, column: str = "reporting_period") -> DataFrame:
    return df.withColumn("period", quarter_start(column))


def delinquency_panel(features: DataFrame) -> DataFrame:
    return with_quarter(features.select("reporting_period", "delq_num")).select(
        "period", "delq_num")


def backtest(panel: DataFrame, m: MonitoringSettings = M) -> DataFrame:
    """Mean predicted against realised rate per quarter with enough loans."""
    g = (panel.groupBy("period")
         .agg(F.count(F.lit(1)).alias("n"), F.avg("pred_pd").alias("mean_pred_pd"),
              F.avg("target").alias("realised_dr"))
         .filter(F.col("n") >= m.min_n))
    ratio = F.col("mean_pred_pd") / F.greatest("realised_dr", F.lit(TINY))
    return g.withColumn("pred_over_realised", ratio).withColumn(
        "rag", traffic_light(F.abs(F.col("pred_over_realised") - 1), m.backtest_amber,
                             m.backtest_red))


def score_stability(panel: DataFrame, m: MonitoringSettings = M) -> DataFrame:
    """Score PSI between consecutive quarters: ``from, to, psi, rag``.

    The panel is read three times: pass stored columns.
    """
    values = panel.select("period", F.lit("pred_pd").alias("feature"), F.col("pred_pd").alias("x"))
    psi = stability(values, "period", m.psi_bins)
    return psi.select("from", "to", "psi",
                      traffic_light(F.col("psi"), m.psi_amber, m.psi_red).alias("rag"))


def delinquency_trend(panel: DataFrame, m: MonitoringSettings = M) -> DataFrame:
    """Share of 30+ and 90+ per quarter among rows with a known status."""
    return panel.groupBy("period").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("delq_num") >= 1).cast("double")).alias("share_30dpd"),
        F.avg((F.col("delq_num") >= m.default_dpd).cast("double")).alias("share_90dpd"))


def lights(backtests: DataFrame, stabilities: DataFrame) -> DataFrame:
    """All lights with their period: ``source, period, rag``."""
    return (
        backtests.select(F.lit("backtest").alias("source"), "period", "rag")
        .unionByName(stabilities.select(F.lit("psi").alias("source"),
                                        F.col("to").alias("period"), "rag")))


def _worst(rag: Column) -> Column:
    level = F.max(F.when(rag == "RED", 2).when(rag == "AMBER", 1).otherwise(0))
    return (F.when(F.count(rag) == 0, "n/a").when(level == 2, "RED")
            .when(level == 1, "AMBER").otherwise("GREEN"))


def status(all_lights: DataFrame) -> DataFrame:
    """Latest status (newest light of each source) and the worst one ever, one row."""
    newest = all_lights.groupBy("source").agg(F.max_by("rag", "period").alias("rag"))
    latest = newest.agg(_worst(F.col("rag")).alias("s")).scalar()
    return all_lights.agg(_worst(F.col("rag")).alias("historical_worst")).select(
        latest.alias("latest_status"), "historical_worst")


def breaches(all_lights: DataFrame) -> DataFrame:
    return all_lights.agg(F.count_if(F.col("rag") == "RED").alias("red"),
                          F.count_if(F.col("rag") == "AMBER").alias("amber"),
                          F.count_if(F.col("rag") == "GREEN").alias("green"))
