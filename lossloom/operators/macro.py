"""Monthly macro table from observations of any frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lossloom.functions.dates import month_start
from lossloom.operators.windows import by_month

YEAR_ON_YEAR = {"hpi": "hpi_yoy", "real_gdp": "gdp_yoy", "cpi": "cpi_yoy"}


def forward_fill(monthly: DataFrame, columns: list[str]) -> DataFrame:
    so_far = by_month().rowsBetween(W.unboundedPreceding, 0)
    return monthly.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in columns})


def year_on_year(monthly: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Percent change over 12 rows of a gap-free monthly table, ``source -> new name``."""
    return monthly.withColumns({
        new: (F.try_divide(F.col(c), F.lag(c, 12).over(by_month())) - 1) * 100
        for c, new in columns.items() if c in monthly.columns})


def monthly_macro(observations: DataFrame, series: list[str], start: str | None = None,
                  end: str | None = None) -> DataFrame:
    """``(series, day, value)`` rows to one gap-free row per month.

    Daily and weekly series become month means, slower ones are carried forward, and year-on-year
    changes are added for prices, output and consumer prices.
    """
    means = (
        observations.filter(F.col("series").isin(*series) & F.col("day").isNotNull())
        .groupBy(month_start("day").alias("reporting_period"))
        .pivot("series", series).agg(F.avg("value"))
    )
    first = F.lit(start).cast("date") if start else F.min("reporting_period")
    last = F.lit(end).cast("date") if end else F.max("reporting_period")
    limits = means.agg(month_start(first).alias("a"), month_start(last).alias("b"))
    spine = limits.filter(F.col("a").isNotNull()).select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("reporting_period"))
    filled = forward_fill(spine.join(means, "reporting_period", "left"), series)
    return year_on_year(filled, YEAR_ON_YEAR)


def latest_values(macro: DataFrame, features: list[str]) -> DataFrame:
    """One row with the most recent known value of every feature."""
    return macro.agg(*[
        F.max_by(f, F.when(F.col(f).isNotNull(), F.col("reporting_period"))).alias(f)
        for f in features])
