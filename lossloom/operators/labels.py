"""Forward-looking default label and competing-risk prepayment label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.functions.dates import month_number
from lossloom.functions.delinquency import code_in
from lossloom.operators.durable import durable, small_side
from lossloom.operators.windows import by_loan, whole_loan
from lossloom.params import EventCodes



def forward_event(horizon: int, default_dpd: int):
    """1 if any of the next ``horizon`` rows of the loan is in default, 0 if none, null at the end."""
    event = (F.coalesce(F.col("delq_num"), F.lit(0)) >= default_dpd).cast("int")
    return F.max(event).over(by_loan().rowsBetween(1, horizon))


def months_left():
    """Calendar months between the row and the last row of its loan."""
    here = month_number("reporting_period")
    return F.max(here).over(whole_loan()) - here


def label_defaults(features: DataFrame, horizon: int, default_dpd: int) -> DataFrame:
    """Performing rows with ``target``: 1 default ahead, 0 a full clean window ahead.

    Look-ahead counts rows, completeness counts calendar months; rows with neither outcome known
    are left out.
    """
    performing = F.coalesce(F.col("delq_num"), F.lit(0)) < default_dpd
    ahead = F.col("_ahead")
    target = F.when(ahead == 1, 1).when(F.col("_left") >= horizon, 0)
    return (
        features.withColumns({"_ahead": forward_event(horizon, default_dpd),
                              "_left": months_left()})
        .withColumn("target", target)
        .filter(performing & F.col("target").isNotNull())
        .drop("_ahead", "_left")
    )


def drop_open_window(labelled: DataFrame, horizon: int) -> DataFrame:
    """Leave out the last ``horizon`` months, whose outcome is not yet fully observed."""
    here = month_number("reporting_period")
    latest = labelled.agg(F.max(here).alias("latest")).scalar()
    return labelled.filter(here <= latest - horizon)


def closed_rate(labelled: DataFrame, horizon: int) -> DataFrame:
    """Mean ``target`` of :func:`drop_open_window`, from stored sums per month: the rows are read once (one row)."""
    months = durable(labelled.groupBy(month_number("reporting_period").alias("month")).agg(
        F.count("target").alias("n"), F.sum("target").alias("bad")))
    latest = months.agg(F.max("month").alias("latest")).scalar()
    return months.filter(F.col("month") <= latest - horizon).agg(
        F.try_divide(F.sum("bad"), F.sum("n")).alias("target"))


def terminal_events(monthly: DataFrame, codes: EventCodes = EventCodes()) -> DataFrame:
    """First prepay month, first default month and last month of every loan."""
    def first_month(wanted):
        return F.min(F.when(code_in("zero_balance_code", wanted), F.col("reporting_period")))

    return monthly.groupBy("loan_id").agg(
        first_month(codes.prepay_loose).alias("prepay_period"),
        first_month(codes.default_loose).alias("default_period"),
        F.max("reporting_period").alias("last_period"))


def label_prepayments(features: DataFrame, terminal: DataFrame, horizon: int,
                      default_dpd: int = 3) -> DataFrame:
    """Active rows with ``target``: 1 prepays first within the horizon, 0 survives it untouched.

    A default that comes first censors the row, as does an incomplete window.
    """
    exits = terminal.select(
        "loan_id",
        month_number("prepay_period").alias("_prepay"),
        month_number("default_period").alias("_default"),
        month_number("last_period").alias("_last"))
    now = month_number("reporting_period")
    prepay, default = F.col("_prepay"), F.col("_default")

    def within(month):
        return F.coalesce((month > now) & (month <= now + horizon), F.lit(False))

    prepay_first = within(prepay) & (default.isNull() | (prepay <= default))
    default_first = within(default) & (prepay.isNull() | (default < prepay))
    untouched = ~within(prepay) & ~within(default) & (F.col("_last") >= now + horizon)
    target = (F.when(prepay_first, 1).when(default_first, F.lit(None).cast("int"))
              .when(untouched, 0))
    active = (prepay.isNull() | (now < prepay)) & (default.isNull() | (now < default))
    performing = F.coalesce(F.col("delq_num"), F.lit(0)) < default_dpd
    return (
        features.join(exits, "loan_id", "left")
        .withColumn("target", target)
        .filter(performing & active & F.col("target").isNotNull())
        .drop("_prepay", "_default", "_last")
    )


def with_refi_incentive(labelled: DataFrame, macro: DataFrame) -> DataFrame:
    """Add market rates, the refinancing incentive and its seasoning interaction."""
    if "mortgage_30y" not in macro.columns:
        raise ValueError("the macro table needs a mortgage_30y column")
    rates = small_side(macro.select("reporting_period", "treasury_10y", "mortgage_30y"))
    note_rate = F.col("int_rate_orig") + F.coalesce(F.col("rate_spread_vs_orig"), F.lit(0.0))
    seasoned = F.when(F.col("months_on_book").isNotNull(),
                      F.least(F.greatest(F.col("months_on_book"), F.lit(0)), F.lit(60)))
    return (
        labelled.join(rates, "reporting_period", "left")
        .withColumn("refi_incentive", note_rate - F.col("mortgage_30y"))
        .withColumn("incentive_burnout", F.col("refi_incentive") * (seasoned / 12.0))
    )


def with_split(labelled: DataFrame, split_date: str) -> DataFrame:
    """``split`` = train before the date, test from it on."""
    return labelled.withColumn(
        "split",
        F.when(F.col("reporting_period") < F.lit(split_date).cast("date"), "train")
        .when(F.col("reporting_period").isNotNull(), "test"))


def default_rate_by_period(labelled: DataFrame, min_n: int = 500) -> DataFrame:
    return (
        labelled.groupBy("reporting_period")
        .agg(F.avg("target").alias("dr"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_n)
    )
