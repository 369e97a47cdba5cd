"""Shared pieces of the registered queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossloom.operators import exposure, features, labels, loss, macro, severity, staging
from lossloom.operators.durable import durable, use_checkpoint_dir
from lossloom.operators.models import column_scorer
from lossloom.operators.regression import LinearFit
from lossloom.params import LossSettings, ScenarioSettings
from workload import sql, tables

SCORE_COLUMNS = ["delq_num", "fico_orig", "current_ltv", "count_30dpd_12m"]
SCENARIOS = ScenarioSettings()
LOSS = LossSettings()
BASE_LGD, DOWNTURN_LGD = 0.33, 0.376
RHO = 0.15


def score():
    return F.expr(sql.SCORE)


def digest(df: DataFrame, value: str, *by: str) -> DataFrame:
    """Counts and mean of one column per cohort cell: every row takes part.

    The mean is scaled by pi, because means of short decimals sit exactly on rounding borders.
    """
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count(value).alias("known"),
        F.round(F.avg(F.col(value).cast("double")) * F.pi(), 4).alias("scaled_mean"))


def digest_sql(value: str, source: str, *by: str) -> str:
    return (f"select {', '.join(by)}, count(*) as n, count({value}) as known, "
            f"round(avg(cast({value} as double)) * pi(), 4) as scaled_mean from {source} "
            f"group by {', '.join(by)}")


CELL = ("vintage", "loan_age")


def feat(spark: SparkSession, sf: str) -> DataFrame:
    return features.with_features(tables.full_panel(spark, sf))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return labels.label_defaults(feat(spark, sf), 12, 3)


LABEL_COLUMNS = ["loan_id", "reporting_period", "target", "delq_num", "fico_orig", "current_ltv",
                 "count_30dpd_12m"]


def closed(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled rows with a complete outcome; stored narrow, as the cut needs their last month."""
    rows = durable(labelled(spark, sf).select(*LABEL_COLUMNS))
    return labels.drop_open_window(rows, 12)


def long_run_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Mean target of :func:`closed`; needs no other column of it, so nothing is stored row by row."""
    return labels.closed_rate(labelled(spark, sf), 12)


def scored(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    return (closed(spark, sf) if rows is None else rows).withColumn("p", score())


def macro_table(spark: SparkSession, sf: str) -> DataFrame:
    return macro.monthly_macro(tables.observations(spark, sf), tables.SERIES)


def losses(spark: SparkSession, sf: str) -> DataFrame:
    events = severity.dispositions(tables.monthly_with_amounts(spark, sf),
                                   tables.master(spark, sf))
    return severity.with_severity(events)


def lgd(spark: SparkSession, sf: str) -> DataFrame:
    return severity.with_current_ltv(losses(spark, sf), macro_table(spark, sf))


def snapshot(spark: SparkSession, sf: str, period: str | None = None) -> DataFrame:
    return staging.staged_inputs(feat(spark, sf), SCORE_COLUMNS, column_scorer(score()), period)


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return staging.with_stage(snapshot(spark, sf))


def book(spark: SparkSession, sf: str, stages: DataFrame | None = None) -> DataFrame:
    return loss.attach_exposure(staged(spark, sf) if stages is None else stages,
                                exposure.latest_exposure(tables.monthly(spark, sf)))


# A fixed macro response stands in for the fitted regression where the fit is not the subject.
RESPONSE = LinearFit(("unemployment", "hpi_yoy", "gdp_yoy", "treasury_10y"),
                     (-0.05, 0.02, 0.03, 0.04), 0.9, 0.0, 0)
RESPONSE_SQL = ("(9e-1 + (-5e-2) * unemployment + 2e-2 * hpi_yoy + 3e-2 * gdp_yoy"
                " + 4e-2 * treasury_10y)")


def scratch(spark: SparkSession) -> str:
    """A new folder on the shared checkpoint storage."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tables-{uuid.uuid4().hex}"
