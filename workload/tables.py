"""Loan tables derived from the orders, customer, nation and lineitem tables.

Only integer arithmetic and row-wise double arithmetic is used, so that every engine gets the
same values (see FIXTURES.md section 2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossloom.functions.dates import month_start, vintage_of

TERM = 360
MAX_MONTHS = 48


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.col("loan_id")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loan per order, with the static fields of the loan master table."""
    day = F.col("o_orderdate").cast("date")
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("c_custkey"),
        month_start(day).alias("origination_date"),
        vintage_of(day).alias("vintage"),
        F.col("o_totalprice").alias("upb_orig"),
    )
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state"))
    k = _k()
    rate = (F.lit(30) + (k * 7) % 36) / 10
    return (
        orders.join(customers, "c_custkey").join(nations, "c_nationkey")
        .select(
            "loan_id", "origination_date", "vintage", "upb_orig",
            (620 + (k * 37) % 200).cast("double").alias("fico_orig"),
            (60 + (k * 13) % 38).cast("double").alias("ltv_orig"),
            (20 + (k * 11) % 31).cast("double").alias("dti_orig"),
            rate.alias("int_rate_orig"),
            "state",
            (6 + (k * 17) % 43).cast("int").alias("n_months"),
        )
    )


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loans(spark, sf_dir).drop("n_months")


def full_panel(spark: SparkSession, sf_dir: str, ranges: tuple[str, ...] = ()) -> DataFrame:
    """One row per loan and month with dynamic and static fields.

    The loans are hashed by id before they are expanded to months: that moves one row per loan
    instead of one per month, and the per-loan windows and joins reuse the placement. ``ranges``
    places them by ranges of these columns instead, for rows that are written by part.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (loans(spark, sf_dir).repartitionByRange(parts, *ranges) if ranges
              else loans(spark, sf_dir).repartition(parts, "loan_id"))
    return loan_months(placed)


def loan_months(placed: DataFrame, *kept: str) -> DataFrame:
    """The panel rows of these loans, where the loans lie, with further loan columns ``kept``."""
    k, m, n = _k(), F.col("m"), F.col("n_months")
    months = placed.withColumn("m", F.explode(F.sequence(F.lit(0), n - 1)))
    months = months.filter(~((k % 11 == 0) & (m == 4)))
    last = m == n - 1
    status = (
        F.when((k % 97 == 0) & (m == 3), "XX")
        .when((k % 10 == 0) & (m >= n - 6),
              F.concat(F.lit("0"), (m - (n - 7)).cast("string")))
        .when((k % 7 == 0) & (m % 12).isin(5, 6), "01")
        .otherwise("00"))
    code = (
        F.when(last & (k % 20 == 0), "09").when(last & (k % 10 == 0), "03")
        .when(last & (k % 10).isin(1, 2, 3), "01"))
    upb = F.when((m == 0) & (k % 3 == 0), 0.0).otherwise(
        F.col("upb_orig") * (TERM - m) / F.lit(TERM))
    return months.select(
        "loan_id",
        F.add_months("origination_date", m).alias("reporting_period"),
        m.cast("double").alias("loan_age"),
        upb.alias("upb_current"),
        F.col("int_rate_orig").alias("int_rate_current"),
        (TERM - m).cast("double").alias("remaining_months_to_maturity"),
        status.alias("delq_status"),
        code.alias("zero_balance_code"),
        F.when((m == 2) & (k % 5 == 0), None).otherwise(F.col("upb_orig") / F.lit(TERM))
        .alias("total_principal_current"),
        "vintage", "origination_date", "fico_orig", "ltv_orig", "dti_orig", "upb_orig",
        "int_rate_orig", "state", *kept,
    )


MONTHLY = ["loan_id", "reporting_period", "loan_age", "upb_current", "int_rate_current",
           "remaining_months_to_maturity", "delq_status", "zero_balance_code",
           "total_principal_current", "vintage"]


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_panel(spark, sf_dir).select(*MONTHLY)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro series ``(series, day, value)`` from shipments: daily ones, and output by quarter."""
    day = F.col("l_shipdate").cast("date")

    def one(name, value, when=day):
        return F.struct(F.lit(name).alias("series"), when.alias("day"), value.alias("value"))

    return read(spark, sf_dir, "lineitem").select(F.explode(F.array(
        one("hpi", F.col("l_extendedprice")),
        one("treasury_10y", 100 * F.col("l_discount")),
        one("mortgage_30y", 100 * F.col("l_tax")),
        one("unemployment", F.when(F.col("l_returnflag") == "R", 100.0).otherwise(0.0)),
        one("real_gdp", F.col("l_quantity"), F.trunc(day, "quarter")),
    )).alias("o")).select("o.*")


SERIES = ["hpi", "treasury_10y", "mortgage_30y", "unemployment", "real_gdp"]


def amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Liquidation costs and proceeds per order, spread over the reported fields."""
    cost = F.col("l_extendedprice") * F.col("l_tax")
    proceed = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("loan_id")).agg(
        F.sum(F.when(flag == "A", cost)).alias("foreclosure_costs"),
        F.sum(F.when(flag == "N", cost)).alias("property_preservation_and_repair_costs"),
        F.sum(F.when(flag == "R", cost)).alias("asset_recovery_costs"),
        F.sum(F.when(status == "F", proceed)).alias("net_sales_proceeds"),
        F.sum(F.when(status == "O", proceed)).alias("other_foreclosure_proceeds"))


def monthly_with_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly rows whose last month carries the liquidation fields."""
    rows = full_panel(spark, sf_dir)
    rows = rows.withColumn("upb_at_the_time_of_removal", F.when(
        F.col("zero_balance_code").isNotNull() & (F.col("loan_id") % 4 == 0),
        F.col("upb_orig") * 0.9))
    exits = rows.filter(F.col("zero_balance_code").isNotNull())
    return exits.select(*MONTHLY, "upb_at_the_time_of_removal").join(
        amounts(spark, sf_dir), "loan_id", "left")
