"""Delinquency, vintage and seasoning aggregates over the monthly panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.functions.delinquency import at_least
from lossloom.params import EventCodes

CODES = EventCodes()


def _flag_sum(months: int) -> Column:
    return F.count_if(at_least("delq_status", months))


def delinquency_by_period(monthly: DataFrame, codes: EventCodes = CODES) -> DataFrame:
    return (
        monthly.filter(F.col("reporting_period").isNotNull())
        .groupBy("reporting_period")
        .agg(F.count(F.lit(1)).alias("active"),
             _flag_sum(codes.dpd30_months).alias("dpd30"),
             _flag_sum(codes.dpd90_months).alias("dpd90"))
    )


def outcomes_by_vintage(monthly: DataFrame, codes: EventCodes = CODES) -> DataFrame:
    """Distinct loans, defaulted loans and prepaid loans per vintage.

    Collapsing to one row per loan first replaces three distinct aggregates by one shuffle.
    """
    code = F.col("zero_balance_code")
    per_loan = (
        monthly.filter(F.col("vintage").isNotNull() & F.col("loan_id").isNotNull())
        .groupBy("vintage", "loan_id")
        .agg(F.max(F.coalesce(code.isin(*codes.default), F.lit(False))).alias("defaulted"),
             F.max(F.coalesce(code == codes.prepay, F.lit(False))).alias("prepaid"))
    )
    return per_loan.groupBy("vintage").agg(
        F.count(F.lit(1)).alias("loans"),
        F.count_if("defaulted").alias("defaults"),
        F.count_if("prepaid").alias("prepaid"))


def _aged(monthly: DataFrame, codes: EventCodes) -> DataFrame:
    return monthly.filter(F.col("loan_age").between(0, codes.max_age))


def seasoning_curve(monthly: DataFrame, codes: EventCodes = CODES) -> DataFrame:
    age = F.col("loan_age").cast("int").alias("loan_age")
    return (_aged(monthly, codes).groupBy(age)
            .agg(F.count(F.lit(1)).alias("n"), _flag_sum(codes.dpd90_months).alias("dpd90")))


def cohort_matrix(monthly: DataFrame, codes: EventCodes = CODES) -> DataFrame:
    return (
        _aged(monthly, codes).filter(F.col("vintage").isNotNull())
        .groupBy("vintage", F.col("loan_age").cast("int").alias("age"))
        .agg(F.count(F.lit(1)).alias("n"), _flag_sum(codes.dpd90_months).alias("dpd90"))
    )


def cohort_pivot(matrix: DataFrame, ages: list[int]) -> DataFrame:
    """90+ rate in percent, one row per vintage and one column ``age_<a>`` per age."""
    rate = matrix.select("vintage", F.concat(F.lit("age_"), F.col("age")).alias("age"),
                         (F.lit(100.0) * F.col("dpd90") / F.col("n")).alias("rate"))
    return rate.groupBy("vintage").pivot("age", [f"age_{a}" for a in ages]).agg(F.first("rate"))


def percent(df: DataFrame, whole: str, **parts: str) -> DataFrame:
    """Add ``name = 100 * part / whole`` for every ``name=part``."""
    return df.withColumns({name: F.try_divide(F.lit(100.0) * F.col(part), F.col(whole))
                           for name, part in parts.items()})


def loans_by_state(master: DataFrame) -> DataFrame:
    return (master.filter(F.col("state").isNotNull())
            .groupBy("state").agg(F.count(F.lit(1)).alias("loans")))


def histograms(master: DataFrame, columns: list[str], bins: int = 50) -> DataFrame:
    """Equal-width histogram of each column: ``feature, bin, lo, hi, n`` (one scan for the limits).

    The limits are one row, so they join as scalar subqueries, not as a shuffle.
    """
    columns = [c for c in columns if c in master.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
                      for c in columns])
    limits = master.agg(F.map_from_arrays(
        F.array(*[F.lit(c) for c in columns]),
        F.array(*[F.struct(F.min(F.col(c).cast("double")).alias("lo"),
                           F.max(F.col(c).cast("double")).alias("hi")) for c in columns])
    ).alias("limits")).scalar()
    long = (
        master.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("x").isNotNull())
        .withColumn("_limit", F.element_at(limits, F.col("feature")))
    )
    lo, hi = F.col("_limit.lo"), F.col("_limit.hi")
    width = (hi - lo) / bins
    slot = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - lo) * bins / F.nullif(hi - lo, F.lit(0.0))),
                F.lit(bins - 1))).cast("int")
    return (
        long.groupBy("feature", slot.alias("bin"), "_limit").agg(F.count(F.lit(1)).alias("n"))
        .select("feature", "bin", (lo + width * F.col("bin")).alias("lo"),
                (lo + width * (F.col("bin") + 1)).alias("hi"), "n")
    )
