"""Features of a new month from a small state per loan, without its history.

The windows of :mod:`lossloom.operators.features` look back a fixed number of rows, count rows, or run
from the first one. So per loan the number of rows, the principal paid so far and the last balances
and delinquencies are enough. A month is merged by one join of its rows with the state; the state is
stored in buckets by loan, and only its new version and the month are written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.operators.durable import durable
from lossloom.operators.features import row_features, with_levels
from lossloom.params import FeatureSettings
from lossloom.sources.versions import VersionedWarehouse

STATE = "loan_id, rows, last_period, paid, balances, delinquencies".split(", ")
TABLE, BUCKET = "feature_state", "bucket"


def depth(s: FeatureSettings) -> int:
    """Rows that the longest window or lag looks back."""
    return max(s.balance_months, s.delq_months, max(s.windows) - 1)


def _last(values: Column, n: int) -> Column:
    return F.slice(values, F.greatest(F.size(values) - n + 1, F.lit(1)), n)


def initial_state(panel: DataFrame, s: FeatureSettings = FeatureSettings()) -> DataFrame:
    """State of every loan after all rows of ``panel``: one row per loan.

    Only the newest rows of a loan are gathered, those of its last months by the calendar; a loan has
    one row per month at most.
    """
    levels = with_levels(panel).select("loan_id", "reporting_period", "total_principal_current",
                                       "delq_num", "_balance")
    totals = levels.groupBy("loan_id").agg(
        F.count(F.lit(1)).alias("rows"), F.max("reporting_period").alias("last_period"),
        F.sum("total_principal_current").alias("paid"),
        F.sort_array(F.collect_list(F.struct("reporting_period", "_balance", "delq_num"))).alias("h"))
    recent = _last(F.col("h"), depth(s))
    return totals.select(
        "loan_id", "rows", "last_period", "paid",
        F.transform(recent, lambda x: x["_balance"]).alias("balances"),
        F.transform(recent, lambda x: x["delq_num"]).alias("delinquencies"))


@dataclass
class Month:
    """Feature rows of a month, the state after it, and rows that came too late for the state."""

    features: DataFrame
    state: DataFrame
    late: DataFrame


def advance(state: DataFrame, rows: DataFrame, s: FeatureSettings = FeatureSettings()) -> Month:
    """Merge the panel rows of one month (at most one per loan, static fields included).

    Rows that are not newer than the state of their loan are ``late``: their features, and those of the
    months after, need the history. Loans without a row keep their state.
    """
    joined = durable(state.join(with_levels(rows), "loan_id", "full"))
    new = F.col("reporting_period").isNotNull() & (
        F.col("last_period").isNull() | (F.col("reporting_period") > F.col("last_period")))
    n, empty = F.coalesce("rows", F.lit(0)), F.array()
    past = {c: F.coalesce(F.col(c), empty.cast(kind)) for c, kind in (
        ("balances", rows_type(joined, "balances")), ("delinquencies", rows_type(joined, "delinquencies")))}
    with_now = {"balances": F.concat(past["balances"], F.array("_balance")),
                "delinquencies": F.concat(past["delinquencies"], F.array("delq_num"))}

    def ago(values: Column, k: int) -> Column:
        """The value ``k`` rows before the new one."""
        at = F.size(values) - 1 - k
        return F.when(at >= 0, F.get(values, at))

    paid = F.col("total_principal_current")
    total = F.when(paid.isNull() & F.col("paid").isNull(), None).otherwise(
        F.coalesce("paid", F.lit(0.0)) + F.coalesce(paid, F.lit(0.0)))
    late_by = with_now["delinquencies"]
    widest = max(s.windows)
    known = F.filter(_last(late_by, widest), lambda x: x.isNotNull())
    count = F.when(F.size(known) > 0, F.size(F.filter(known, lambda x: x >= s.dpd30_months)).cast("bigint"))
    columns = {
        "months_on_book": n.cast("bigint"), **row_features(),
        "cum_principal_paid": F.when(paid.isNotNull(), total),
        f"balance_change_{s.balance_months}m":
            F.col("_balance") / ago(with_now["balances"], s.balance_months) - 1,
        f"delq_change_{s.delq_months}m":
            (F.col("delq_num") - ago(late_by, s.delq_months)).cast("double"),
        **{f"max_delq_{k}m": F.array_max(_last(late_by, k)) for k in s.windows},
        f"count_30dpd_{widest}m": count,
        f"ever_30dpd_{widest}m": (count > 0).cast("bigint")}
    fresh = joined.filter(new)
    features = fresh.withColumns(columns).select(*rows.columns, "delq_num", *columns)
    merged = fresh.select(
        "loan_id", (n + 1).cast("bigint").alias("rows"), F.col("reporting_period").alias("last_period"),
        total.alias("paid"), *[_last(v, depth(s)).alias(c) for c, v in with_now.items()])
    same = joined.filter(~new).select(*STATE)
    late = joined.filter(~new & F.col("reporting_period").isNotNull()).select(*rows.columns)
    return Month(features, merged.unionByName(same), late)


def rows_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def save_state(store: VersionedWarehouse, state: DataFrame, buckets: int = 64) -> None:
    """Store the state in buckets by loan; readers of the old one are not disturbed."""
    part = F.pmod(F.xxhash64("loan_id"), F.lit(buckets)).cast("int")
    with store.load() as change:
        change.replace_parts(state.withColumn(BUCKET, part).repartition(buckets, BUCKET), TABLE, [BUCKET])


def add_month(store: VersionedWarehouse, rows: DataFrame, features_table: str,
              s: FeatureSettings = FeatureSettings(), buckets: int = 64) -> int:
    """Features of a month appended to ``features_table``, with the state moved on in the same load.

    Reads the new rows and the state, nothing else. Returns how many rows were late and left out.
    """
    month = advance(store.read(TABLE).drop(BUCKET), rows, s)
    part = F.pmod(F.xxhash64("loan_id"), F.lit(buckets)).cast("int")
    with store.load() as change:
        change.append(month.features, features_table)
        change.replace_parts(month.state.withColumn(BUCKET, part).repartition(buckets, BUCKET), TABLE,
                             [BUCKET])
    return month.late.count()
