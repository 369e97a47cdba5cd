"""Credit-deterioration stages of the book."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.operators.models import Scorer
from lossloom.params import StagingSettings

TINY = 1e-6


def with_stage(df: DataFrame, s: StagingSettings = StagingSettings(), delq: str = "delq_num",
               pd_now: str = "pd_now", pd_orig: str = "pd_orig", watch: str | None = None,
               default_flag: str | None = None) -> DataFrame:
    """Add ``stage`` (3 default, 2 deteriorated, 1 rest) and the trigger flags.

    An unknown delinquency leaves its flags unknown and never moves a loan by itself.
    """
    def optional(flag: Column, name: str | None) -> Column:
        return flag | F.col(name) if name and name in df.columns else flag

    in_default = optional(F.col(delq) >= s.default_dpd, default_flag)
    late = F.col(delq) >= s.backstop_dpd
    worse = (
        (F.col(pd_now) / F.greatest(F.col(pd_orig), F.lit(TINY)) >= s.pd_rel)
        | (F.col(pd_now) - F.col(pd_orig) >= s.pd_abs))
    risen = optional(late | worse, watch)
    return df.withColumns({
        "stage": F.when(in_default, 3).when(risen, 2).otherwise(1),
        "is_default": in_default,
        "sicr_backstop_30dpd": late,
        "sicr_pd_deterioration": worse,
    })


def first_and_current_rows(features: DataFrame, columns: list[str],
                           period: str | None = None) -> DataFrame:
    """One row per loan: struct ``first`` (lowest loan age) and ``current`` (latest, or ``period``).

    Both come out of one aggregation, so the book is shuffled once and never joined to itself.
    Unknown loan age sorts first. Loans without a current row are left out.
    """
    carried = [F.col(c) for c in dict.fromkeys([*columns, "delq_num"])]
    current = F.struct("reporting_period", *carried)
    if period:
        current = F.when(F.col("reporting_period") == F.lit(period).cast("date"), current)
    age = F.col("loan_age").alias("_age")
    return (
        features.groupBy("loan_id")
        .agg(F.min(F.struct(age, F.col("reporting_period"), *carried)).alias("first"),
             F.max(current).alias("current"))
        .filter(F.col("current").isNotNull())
    )


def staged_inputs(features: DataFrame, columns: list[str], scorer: Scorer,
                  period: str | None = None) -> DataFrame:
    """``loan_id, reporting_period, delq_num, pd_orig, pd_now`` of the current book."""
    rows = first_and_current_rows(features, columns, period)
    both = rows.select("loan_id", "current", F.explode(F.array(
        F.struct(F.lit(False).alias("is_now"), *[F.col(f"first.{c}").alias(c) for c in columns]),
        F.struct(F.lit(True).alias("is_now"), *[F.col(f"current.{c}").alias(c) for c in columns]),
    )).alias("v")).select("loan_id", F.col("current.reporting_period").alias("_period"),
                          F.col("current.delq_num").alias("_delq"), "v.*")
    scored = scorer(both)
    # Rows of a loan are still hashed by loan_id, so this adds no shuffle.
    return (
        scored.groupBy("loan_id")
        .agg(F.max("_period").alias("reporting_period"), F.max("_delq").alias("delq_num"),
             F.max(F.when(~F.col("is_now"), F.col("pd"))).alias("_orig"),
             F.max(F.when(F.col("is_now"), F.col("pd"))).alias("pd_now"))
        .select("loan_id", "reporting_period", "delq_num",
                F.coalesce("_orig", "pd_now").alias("pd_orig"), "pd_now")
    )


def stage_distribution(staged: DataFrame) -> DataFrame:
    counts = staged.groupBy("stage").agg(F.count(F.lit(1)).alias("n"))
    total = staged.agg(F.count(F.lit(1)).alias("t")).scalar()
    return counts.withColumn("pct", F.round(F.col("n") / F.greatest(total, F.lit(1)) * 100, 2))


def trigger_counts(staged: DataFrame) -> DataFrame:
    return staged.agg(F.count_if("is_default").alias("default_90dpd"),
                      F.count_if("sicr_backstop_30dpd").alias("backstop_30dpd"),
                      F.count_if("sicr_pd_deterioration").alias("pd_deterioration"))


def migration_matrix(previous: DataFrame, current: DataFrame, key: str = "loan_id") -> DataFrame:
    """Stage transitions of the loans present in both snapshots."""
    before = previous.select(key, F.col("stage").alias("stage_from"))
    after = current.select(key, F.col("stage").alias("stage_to"))
    return (before.join(after, key).groupBy("stage_from", "stage_to")
            .agg(F.count(F.lit(1)).alias("n")))
