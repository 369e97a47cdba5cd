"""Panel assembly and per-loan window features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lossloom.functions.delinquency import months_past_due, usable_balance
from lossloom.operators.durable import small_side
from lossloom.operators.windows import by_loan
from lossloom.params import FeatureSettings

ID_COLUMNS = ["loan_id", "reporting_period", "vintage", "state"]
RAW_COLUMNS = ["fico_orig", "ltv_orig", "dti_orig", "upb_orig", "int_rate_orig", "upb_current",
               "int_rate_current", "loan_age", "delq_num"]
MASTER_COLUMNS = ["loan_id", "fico_orig", "ltv_orig", "dti_orig", "upb_orig", "int_rate_orig",
                  "state"]
MONTHLY_COLUMNS = ["loan_id", "reporting_period", "loan_age", "upb_current", "int_rate_current",
                   "delq_status", "total_principal_current", "vintage"]



def loan_month_panel(monthly: DataFrame, master: DataFrame,
                     vintages: list[str] | None = None) -> DataFrame:
    """Monthly rows with the static loan fields.

    The join leaves rows hashed by ``loan_id``, which the per-loan windows reuse. Rows without a
    loan id drop out here, so no null key reaches a window.
    """
    if vintages is not None:
        monthly = monthly.filter(F.col("vintage").isin(*vintages))
    return monthly.select(*MONTHLY_COLUMNS).join(master.select(*MASTER_COLUMNS), "loan_id")


def row_features() -> dict[str, Column]:
    """Features of a row alone, from the panel with ``_balance``."""
    sized = F.col("upb_orig") > 0
    return {
        "current_ltv": F.when(sized, F.col("ltv_orig") * F.col("_balance") / F.col("upb_orig")),
        "upb_paydown_ratio": F.when(sized, 1 - F.col("_balance") / F.col("upb_orig")),
        "rate_spread_vs_orig": F.col("int_rate_current") - F.col("int_rate_orig"),
    }


def with_levels(panel: DataFrame) -> DataFrame:
    """Months past due and usable balance of every row."""
    return panel.withColumns({"delq_num": months_past_due("delq_status"),
                              "_balance": usable_balance("upb_current")})


def with_features(panel: DataFrame, s: FeatureSettings = FeatureSettings(),
                  placed: tuple[str, ...] = ()) -> DataFrame:
    """Add the engineered columns; all windows share one partitioning and one sort.

    ``placed`` names columns with one value per loan by which the rows are placed already.
    """
    widest = max(s.windows)
    loan = by_loan(*placed)

    def last_rows(n: int):
        return loan.rowsBetween(-(n - 1), 0)

    levels = with_levels(panel)
    paid = F.col("total_principal_current")
    new = {
        "months_on_book": (F.row_number().over(loan) - 1).cast("bigint"),
        **row_features(),
        "cum_principal_paid": F.when(
            paid.isNotNull(),
            F.sum(paid).over(loan.rowsBetween(W.unboundedPreceding, 0))),
        f"balance_change_{s.balance_months}m":
            F.col("_balance") / F.lag("_balance", s.balance_months).over(loan) - 1,
        f"delq_change_{s.delq_months}m":
            (F.col("delq_num") - F.lag("delq_num", s.delq_months).over(loan)).cast("double"),
    }
    for n in s.windows:
        new[f"max_delq_{n}m"] = F.max("delq_num").over(last_rows(n))
    count = F.sum((F.col("delq_num") >= s.dpd30_months).cast("bigint")).over(last_rows(widest))
    new[f"count_30dpd_{widest}m"] = count
    wide = levels.withColumns(new)
    return wide.withColumn(
        f"ever_30dpd_{widest}m", (F.col(f"count_30dpd_{widest}m") > 0).cast("bigint")
    ).drop("_balance")


def vintage_statistics(master: DataFrame) -> DataFrame:
    return master.groupBy("vintage").agg(
        F.count(F.lit(1)).alias("vintage_loan_count"),
        F.coalesce(F.avg("fico_orig"), F.lit(0.0)).alias("vintage_avg_fico"))


def with_vintage_statistics(panel: DataFrame, master: DataFrame) -> DataFrame:
    """Attach cohort size and mean score; the statistics have one row per vintage."""
    return panel.join(small_side(vintage_statistics(master)), "vintage")


def with_macro(panel: DataFrame, macro: DataFrame | None,
               columns: list[str] | None = None) -> DataFrame:
    """Attach macro series by month; the panel is unchanged when there is no usable macro table."""
    if macro is None or "reporting_period" not in macro.columns:
        return panel
    if columns is not None:
        macro = macro.select("reporting_period", *columns)
    return panel.join(small_side(macro), "reporting_period", "left")


def feature_table(monthly: DataFrame, master: DataFrame, macro: DataFrame | None = None,
                  s: FeatureSettings = FeatureSettings(),
                  vintages: list[str] | None = None) -> DataFrame:
    """Feature-store rows: ids, raw fields, then the engineered columns in name order."""
    wide = with_features(loan_month_panel(monthly, master, vintages), s)
    wide = with_macro(with_vintage_statistics(wide, master), macro)
    helpers = {"delq_status", "total_principal_current"}
    engineered = sorted(set(wide.columns) - set(ID_COLUMNS) - set(RAW_COLUMNS) - helpers)
    return wide.select(*ID_COLUMNS, *RAW_COLUMNS, *engineered)
