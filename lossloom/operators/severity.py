"""Realised loss severity, its statistics and downturn level."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.functions.bounds import clip
from lossloom.functions.dates import month_number, month_start
from lossloom.functions.delinquency import code_in, usable_balance
from lossloom.operators import ranks
from lossloom.operators.durable import durable, small_side
from lossloom.operators.regression import LinearFit, clipped
from lossloom.operators.windows import by_month
from lossloom.params import EventCodes, LgdSettings

# Cost and proceeds fields of a liquidation.
COSTS = ["foreclosure_costs", "property_preservation_and_repair_costs", "asset_recovery_costs",
         "miscellaneous_holding_expenses_and_credits", "associated_taxes_for_holding_property"]
PROCEEDS = ["net_sales_proceeds", "credit_enhancement_proceeds", "other_foreclosure_proceeds",
            "repurchase_make_whole_proceeds"]
BALANCES = ["upb_at_the_time_of_removal", "upb_current", "foreclosure_principal_write_off_amount"]
REPORTED = "cumulative_credit_event_net_gain_or_loss"
STATIC = ["ltv_orig", "fico_orig", "upb_orig", "origination_date", "state"]


def _pick(df: DataFrame, names: list[str]) -> list[Column]:
    """The columns that exist; the rest as nulls."""
    return [F.col(c) if c in df.columns else F.lit(None).cast("double").alias(c) for c in names]


def dispositions(monthly: DataFrame, master: DataFrame,
                 codes: EventCodes = EventCodes()) -> DataFrame:
    """Credit-event rows with their loan's static fields, whatever columns the tables have."""
    events = monthly.filter(code_in("zero_balance_code", codes.default))
    wanted = [F.col("loan_id"), F.col("reporting_period").alias("default_period")]
    wanted += _pick(events, [*BALANCES, "loan_age", *COSTS, *PROCEEDS])
    if REPORTED in events.columns:
        wanted.append(F.col(REPORTED))
    from_monthly = [c for c in STATIC if c not in master.columns]
    wanted += _pick(events, from_monthly)
    static = master.select("loan_id", *[c for c in STATIC if c in master.columns])
    return events.select(*wanted).join(static, "loan_id")


def default_balance() -> Column:
    """Balance at removal if positive, else the current one, else the written-off principal."""
    return F.coalesce(*[usable_balance(c) for c in BALANCES],
                      F.coalesce(F.col(BALANCES[-1]), F.lit(0.0)))


def _total(columns: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in columns])


def with_severity(events: DataFrame) -> DataFrame:
    """Add ``default_upb, net_loss, lgd_raw, lgd`` and keep the rows where the loss is known."""
    balance, costs, proceeds = F.col("default_upb"), _total(COSTS), _total(PROCEEDS)
    net = F.when(costs + proceeds > 0, balance + costs - proceeds)
    if REPORTED in events.columns:
        net = net.otherwise(-F.col(REPORTED))
    return (
        events.withColumn("default_upb", default_balance())
        .withColumn("net_loss", net)
        .withColumn("lgd_raw", F.try_divide("net_loss", F.nullif("default_upb", F.lit(0.0))))
        .withColumn("lgd", clip(F.col("lgd_raw"), 0.0, 1.0))
        .filter(F.col("lgd").isNotNull() & (balance > 0))
    )


def with_current_ltv(losses: DataFrame, macro: DataFrame, index: str = "hpi") -> DataFrame:
    """Add ``mtm_ltv`` (house-price adjusted, else amortised) and ``loan_age_years``."""
    prices = durable(
        macro.groupBy(month_number("reporting_period").alias("_month"))
        .agg(F.max_by(index, "reporting_period").alias("_hpi")))
    then = small_side(prices.select(F.col("_month").alias("_m0"), F.col("_hpi").alias("_hpi_then")))
    now = small_side(prices.select(F.col("_month").alias("_m1"), F.col("_hpi").alias("_hpi_now")))
    amortised = F.try_divide(F.col("ltv_orig") * F.col("default_upb"), F.col("upb_orig"))
    keyed = losses.withColumns({"_m0": month_number("origination_date"),
                                "_m1": month_number("default_period")})
    return (
        keyed.join(then, "_m0", "left")
        .join(now, "_m1", "left")
        .withColumn("_ltv", amortised)
        .withColumn("mtm_ltv", F.coalesce(
            F.try_divide(F.col("_ltv") * F.col("_hpi_then"), F.col("_hpi_now")), F.col("_ltv")))
        .withColumn("loan_age_years", F.col("loan_age") / 12.0)
        .drop("_m0", "_m1", "_hpi_then", "_hpi_now", "_ltv")
    )


def severity_statistics(losses: DataFrame) -> DataFrame:
    """``n, mean, median, std, p10, p90`` of the severity (population deviation)."""
    known = losses.filter(F.col("lgd").isNotNull() & ~F.isnan("lgd"))
    q = ranks.exact_quantiles(known, [], "lgd", [0.5, 0.1, 0.9]).select("quantiles").scalar()
    return (
        known.agg(F.count("lgd").alias("n"), F.avg("lgd").alias("mean"),
                  F.stddev_pop("lgd").alias("std"))
        .withColumn("_q", q)
        .select("n", "mean", F.get("_q", F.lit(0)).alias("median"), "std",
                F.get("_q", F.lit(1)).alias("p10"), F.get("_q", F.lit(2)).alias("p90"))
    )


def bucket_label(c: Column, limits: tuple) -> Column:
    """``lo-hi`` label of half-open buckets, null outside all of them."""
    label = F.when(F.lit(False), F.lit(""))
    for lo, hi in zip(limits[:-1], limits[1:]):
        label = label.when((c >= lo) & (c < hi), F.lit(f"{lo}-{hi}"))
    return label


def severity_by_bucket(losses: DataFrame, limits: tuple = LgdSettings().buckets) -> DataFrame:
    return (
        losses.withColumn("ltv_bucket", bucket_label(F.col("mtm_ltv"), limits))
        .filter(F.col("ltv_bucket").isNotNull())
        .groupBy("ltv_bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("lgd").alias("mean_lgd"))
    )


def rolling_windows(losses: DataFrame, months: int = 24) -> DataFrame:
    """Mean severity of every full window of calendar months, gaps counted as empty months."""
    monthly = (
        losses.filter(F.col("default_period").isNotNull())
        .groupBy(month_start("default_period").alias("month"))
        .agg(F.sum("lgd").alias("s"), F.count("lgd").alias("c")))
    spine = monthly.agg(F.min("month").alias("a"), F.max("month").alias("b")).filter(
        F.col("a").isNotNull()).select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month"))
    frame = by_month("month")
    last = frame.rowsBetween(-(months - 1), 0)
    return (
        spine.join(monthly, "month", "left")
        .withColumns({
            "n_obs": F.sum(F.coalesce("c", F.lit(0))).over(last),
            "_s": F.sum(F.coalesce("s", F.lit(0.0))).over(last),
            "_filled": F.count(F.lit(1)).over(last)})
        .filter(F.col("_filled") == months)
        .select(F.add_months("month", -(months - 1)).alias("window_start"),
                F.col("month").alias("window_end"), "n_obs",
                F.try_divide("_s", "n_obs").alias("lgd"))
    )


def worst_window(losses: DataFrame, months: int = 24, min_obs: int = 100) -> DataFrame:
    """The window with the highest mean severity (the earliest on ties); no row if all are thin."""
    windows = rolling_windows(losses, months).filter(
        (F.col("n_obs") >= min_obs) & F.col("lgd").isNotNull())
    return windows.orderBy(F.desc("lgd"), "window_end").limit(1)


def downturn_severity(losses: DataFrame, fit: LinearFit, worst: DataFrame,
                      s: LgdSettings = LgdSettings()) -> DataFrame:
    """Highest of worst observed window, house-price-stressed model and benchmark, one row."""
    stressed = {}
    if "mtm_ltv" in fit.features:
        stressed["mtm_ltv"] = F.col("mtm_ltv") / (1.0 + s.hpi_shock)
    base = losses.agg(
        F.avg(clipped(fit.column(), s.floor)).alias("base_mean_lgd"),
        F.avg(clipped(fit.column(**stressed), s.floor)).alias("model_downturn_lgd"))
    observed = worst.agg(F.max("lgd").alias("x")).scalar()
    return downturn_choice(base.withColumns(
        {"empirical_lgd": observed, "benchmark": F.lit(float(s.benchmark))}))


def downturn_choice(candidates: DataFrame) -> DataFrame:
    """Pick the highest candidate (observed, then model, then benchmark on ties)."""
    seen = F.coalesce(F.col("empirical_lgd"), F.lit(0.0))
    model, bench = F.col("model_downturn_lgd"), F.col("benchmark")
    top = F.greatest(seen, model, bench)
    return (
        candidates.withColumn("driver", F.when(seen == top, "empirical")
                              .when(model == top, "model").otherwise("benchmark"))
        .withColumn("downturn_lgd", top)
        .withColumn("uplift_ratio", top / F.greatest("base_mean_lgd", F.lit(1e-6)))
    )
