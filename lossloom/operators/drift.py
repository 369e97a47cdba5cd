"""Population stability between consecutive groups, and gaps in the quarter sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lossloom.functions.dates import quarter_index, quarter_label
from lossloom.operators import ranks
from lossloom.operators.durable import durable, small_side
from lossloom.operators.quality import _row, long_values
from lossloom.params import QualityLimits

FLOOR = 1e-6
MIN_ROWS = 20


def stability(values: DataFrame, period: str, bins: int = 10) -> DataFrame:
    """PSI of each period against the one before it, for every feature, in one job.

    ``values`` has ``period``, ``feature`` and ``x``. Bins are the earlier period's quantiles. They
    come from compacted counts; then rows are counted per bin of both sets of edges, combined
    before the shuffle, so no distinct values are shuffled. ``values`` is read three times: pass
    stored columns. Rows come out for every consecutive pair of periods, ``psi`` is null where a
    side has too few rows or bins.
    """
    keys = ["feature", period]
    values = values.filter(F.col(period).isNotNull())
    probs = [i / bins for i in range(bins + 1)]
    _, ranked = ranks.ranked_counts(values, keys, "x", probs, keep_nulls=True)
    quantiles = ranks.quantiles_of_counts(ranked, keys, "x", probs)
    in_order = W.partitionBy("feature").orderBy(period)
    # One row per feature and period: the number of quarters, not of loans.
    edges = small_side(quantiles.select(
        "feature", period, "n_total",
        F.array_distinct("quantiles").alias("own"),
        F.lag(F.array_distinct("quantiles")).over(in_order).alias("earlier"),
        F.lag("n_total").over(in_order).alias("earlier_n"),
        F.lag(period).over(in_order).alias("from"),
        F.lead(period).over(in_order).alias("next")))

    def usable(edge_col: str, mine: str, other: str) -> Column:
        return ((F.size(edge_col) >= 3) & (F.col(mine) >= MIN_ROWS) & (F.col(other) >= MIN_ROWS))

    x = F.col("x").cast("double")
    rows = values.select(*keys, x.alias("x")).filter(x.isNotNull() & ~F.isnan(x))
    binned = rows.join(edges.select(*keys, "own", "earlier", "from", "next"), keys).select(
        *keys, "from", "next", ranks.bin_of(F.col("x"), F.col("own"), bins).alias("_own_bin"),
        F.when(F.col("earlier").isNotNull(),
               ranks.bin_of(F.col("x"), F.col("earlier"), bins)).alias("_earlier_bin")
    ).groupBy(*keys, "from", "next", "_own_bin", "_earlier_bin").agg(
        F.count(F.lit(1)).alias("n"))
    sides = binned.select("feature", "n", F.explode(F.array(
        F.struct(F.col("next").alias("to"), F.col("_own_bin").alias("bin"),
                 F.lit(True).alias("is_base")),
        F.struct(F.when(F.col("from").isNotNull(), F.col(period)).alias("to"),
                 F.col("_earlier_bin").alias("bin"), F.lit(False).alias("is_base")),
    )).alias("s")).select("feature", "n", "s.*").filter(F.col("to").isNotNull())
    per_bin = sides.groupBy("feature", "to", "bin").agg(
        F.sum(F.when(F.col("is_base"), F.col("n")).otherwise(0)).alias("base"),
        F.sum(F.when(~F.col("is_base"), F.col("n")).otherwise(0)).alias("comp"))
    pairs = edges.filter(F.col("from").isNotNull()).select(
        "feature", F.col(period).alias("to"), "from", "earlier_n", "n_total",
        usable("earlier", "earlier_n", "n_total").alias("_ok"))
    b = F.greatest(F.try_divide("base", "earlier_n"), F.lit(FLOOR))
    c = F.greatest(F.try_divide("comp", "n_total"), F.lit(FLOOR))
    # Bins that are empty on both sides add (floor - floor) * ln 1 = 0 and need no row.
    return (
        pairs.join(per_bin, ["feature", "to"], "left")
        .groupBy("feature", "from", "to", "_ok")
        .agg(F.sum((c - b) * F.ln(c / b)).alias("psi"))
        .select("feature", "from", "to", F.when(F.col("_ok"), F.col("psi")).alias("psi"))
    )


def stability_of_two(df: DataFrame, baseline: str, compare: str, bins: int = 10) -> DataFrame:
    """PSI of one column against another of the same rows (one row, ``psi``)."""
    df = durable(df.select(baseline, compare))  # read three times
    both = df.select(F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col(baseline).cast("double").alias("x")),
        F.struct(F.lit(1).alias("side"), F.col(compare).cast("double").alias("x")))).alias("v"))
    long = both.select("v.side", F.lit(compare).alias("feature"), "v.x")
    return stability(long, "side", bins).select("psi")


def drift_checks(master: DataFrame, q: QualityLimits = QualityLimits()) -> DataFrame:
    """One result row per feature and consecutive vintage pair with a computable PSI.

    Only the quarter and the checked features are read, once.
    """
    features = [c for c in q.drift_features if c in master.columns]
    labelled = durable(master.filter(F.col("vintage") != "").select("vintage", *features))
    psi = stability(long_values(labelled, features, ("vintage",)), "vintage", q.psi_bins)
    v = F.col("psi")
    status = (F.when(v > q.psi_alert, "FAIL").when(v > q.psi_warn, "WARN").otherwise("PASS"))
    metric = F.concat(F.lit("psi_"), F.col("to"), F.lit("_vs_"), F.col("from"))
    return psi.filter(v.isNotNull()).select(_row(
        "loan_master", "drift", F.col("feature"), metric, F.round(v, 4), q.psi_warn, status,
        F.concat(F.col("feature"), F.lit(" "), F.col("to"), F.lit(" against "), F.col("from")),
    ).alias("r")).select("r.*")


def missing_quarters(master: DataFrame) -> DataFrame:
    """Quarters without loans between the first and the last vintage."""
    present = (master.select(quarter_index("vintage").alias("q"))
               .filter(F.col("q").isNotNull()).distinct())
    spine = present.agg(F.min("q").alias("a"), F.max("q").alias("b")).filter(
        F.col("a").isNotNull()).select(F.explode(F.sequence("a", "b")).alias("q"))
    return spine.join(present, "q", "left_anti").select(quarter_label("q").alias("vintage"))


def coverage_check(master: DataFrame) -> DataFrame:
    """Quarters without loans. Labels that are no quarter of this century are not judged; the message
    says how many loans have one."""
    vintages = durable(master.groupBy("vintage").agg(F.count(F.lit(1)).alias("loans")))
    gaps = missing_quarters(vintages).agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("vintage")).alias("gaps"))
    left_out = vintages.filter(quarter_index("vintage").isNull()).agg(
        F.coalesce(F.sum("loans"), F.lit(0)).alias("left_out")).scalar()
    n = F.col("n")
    found = F.when(n > 0, F.concat(F.lit("missing: "), F.array_join("gaps", ", "))).otherwise("no gaps")
    return gaps.withColumn("left_out", left_out).select(_row(
        "loan_master", "coverage", "vintage", "missing_quarters", n, 0,
        F.when(n > 0, "WARN").otherwise("PASS"),
        F.when(F.col("left_out") > 0, F.concat(found, F.lit("; "), F.col("left_out"), F.lit(
            " loan(s) without a known quarter"))).otherwise(found)).alias("r")).select("r.*")
