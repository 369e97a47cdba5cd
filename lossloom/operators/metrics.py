"""Ranking and calibration metrics over (possibly very many) scored rows.

Everything comes from counts per distinct score, accumulated with
:mod:`lossloom.operators.ranks`; ``by`` evaluates several models or periods in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lossloom.operators import ranks


def score_counts(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct scores cut into stored slices: columns ``by..., p, n, bad, good``."""
    counts = ranks.value_counts(
        df.select(*by, F.col(score).alias("p"), F.col(y).alias("_y")), list(by), "p",
        bad=(F.col("_y") == 1).cast("bigint"), good=(F.col("_y") == 0).cast("bigint"))
    return ranks.cut_into_slices(counts, list(by), "p")


def ranking_metrics(sliced: DataFrame, by: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    """AUC (ties count half), Gini, KS, precision, recall, Brier score, bad rate and size."""
    r = ranks.running_totals(sliced, list(by), "p", ["bad", "good"])
    bad, good = F.col("bad"), F.col("good")
    good_below = F.col("good_before").cast("double")
    gap = F.abs(
        (F.col("bad_before") + bad) / F.greatest(F.col("bad_total"), F.lit(1))
        - (F.col("good_before") + good) / F.greatest(F.col("good_total"), F.lit(1)))
    flagged = F.col("p") >= threshold
    sums = r.groupBy(*by).agg(
        F.sum(bad.cast("double") * (good_below + good / 2)).alias("_wins"),
        F.max(gap).alias("ks"),
        F.sum(bad).alias("_bad"), F.sum(good).alias("_good"),
        F.sum(F.when(flagged, bad).otherwise(0)).alias("_hits"),
        F.sum(F.when(flagged, bad + good).otherwise(0)).alias("_flagged"),
        F.sum(bad * F.pow(1 - F.col("p"), 2) + good * F.pow("p", 2)).alias("_loss"))
    n = F.col("_bad") + F.col("_good")
    auc = F.try_divide("_wins", F.col("_bad").cast("double") * F.col("_good"))
    return sums.select(
        *by, auc.alias("auc"), (2 * auc - 1).alias("gini"), "ks",
        F.coalesce(F.try_divide("_hits", "_flagged"), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide("_hits", "_bad"), F.lit(0.0)).alias("recall"),
        (F.col("_loss") / n).alias("brier"),
        (F.col("_bad") / n).alias("default_rate"), n.alias("n"))


def _holds_chosen(first: Column, end: Column, size: Column, max_points: int | None) -> Column:
    """Does [first, end) hold one of ``max_points`` evenly spaced positions out of ``size``?

    None chooses every position. Position i is the rounded i * step; only the three i around
    ``first / step`` can be the smallest position at or after ``first``.
    """
    if max_points is None:
        return F.lit(True)
    step = (size - 1) / F.lit(float(max_points - 1))
    near = F.floor(F.try_divide(first, step))
    hit = F.lit(False)
    for shift in (-1, 0, 1):
        at = F.rint((near + shift) * step)
        hit = hit | ((near + shift >= 0) & (at >= first) & (at < end))
    return F.when(size <= max_points, F.lit(True)).otherwise(F.coalesce(hit, F.lit(False)))


def roc_points(sliced: DataFrame, by: Sequence[str] = (), max_points: int | None = 60) -> DataFrame:
    """ROC curve from high to low score without collinear points, thinned evenly.

    Starts at (0, 0). A point between the first and the last is dropped when its step equals
    the step that follows it.
    """
    by = list(by)
    down = (ranks.running_totals(
        sliced, by, "p", ["bad", "good"],
        edges={"_next_bad": ("bad", "lag"), "_next_good": ("good", "lag")}))
    bottom = F.col("_next_bad").isNull()
    top = ((F.col("bad_before") + F.col("bad") == F.col("bad_total"))
           & (F.col("good_before") + F.col("good") == F.col("good_total")))
    bends = (bottom | top | (F.col("bad") != F.col("_next_bad"))
             | (F.col("good") != F.col("_next_good")))
    kept = down.withColumn("_kept", bends.cast("bigint"))
    numbered = ranks.running_totals(kept, by, "p", ["_kept"])
    # Counting from the top score: points above this one, plus the origin at position 0.
    position = F.col("_kept_total") - F.col("_kept_before")
    points = numbered.filter(F.col("_kept") == 1).select(
        *by, position.alias("_at"), (F.col("_kept_total") + 1).alias("_size"),
        F.try_divide(F.col("good_total") - F.col("good_before"), F.col("good_total")).alias("fpr"),
        F.try_divide(F.col("bad_total") - F.col("bad_before"), F.col("bad_total")).alias("tpr"))
    origin = points.filter(F.col("_at") == 1).select(
        *by, F.lit(0).cast("bigint").alias("_at"), "_size",
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    curve = points.unionByName(origin)
    wanted = _holds_chosen(F.col("_at"), F.col("_at") + 1, F.col("_size"), max_points)
    return curve.filter(wanted).select(*by, F.col("_at").alias("position"), "fpr", "tpr")


def ks_points(sliced: DataFrame, by: Sequence[str] = (), max_points: int | None = 60) -> DataFrame:
    """Cumulative bad and good shares at evenly spaced population positions, low score first.

    Rows with equal scores form one step, so a position inside it reports the step's end.
    """
    by = list(by)
    r = ranks.running_totals(sliced, by, "p", ["n", "bad", "good"])
    first, end = F.col("n_before"), F.col("n_before") + F.col("n")
    inside = _holds_chosen(first, end, F.col("n_total"), max_points)
    return r.filter(inside).select(
        *by, (end / F.col("n_total")).alias("pop_pct"),
        ((F.col("bad_before") + F.col("bad")) / F.greatest(F.col("bad_total"), F.lit(1)))
        .alias("cum_bad"),
        ((F.col("good_before") + F.col("good")) / F.greatest(F.col("good_total"), F.lit(1)))
        .alias("cum_good"))


def calibration_table(sliced: DataFrame, by: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """Mean score against observed rate in quantile bins: ``bin, n, pred_pd, obs_default``."""
    by = list(by)
    ranked = ranks.running_totals(sliced, by, "p", ["n"])
    edges = ranks.quantiles_of_counts(ranked, by, "p", [i / bins for i in range(bins + 1)])
    edges = edges.select(*by, F.array_distinct("quantiles").alias("edges"))
    if by:
        placed = sliced.join(edges, by)
    else:
        placed = sliced.withColumn("edges", edges.select("edges").scalar())
    return (
        placed.withColumn("bin", ranks.bin_of(F.col("p"), F.col("edges"), bins))
        .groupBy(*by, "bin")
        .agg(F.sum("n").alias("n"), (F.sum(F.col("p") * F.col("n")) / F.sum("n")).alias("pred_pd"),
             (F.sum("bad") / F.sum("n")).alias("obs_default"))
    )


def best_by_auc(metrics: DataFrame, model: str = "model") -> DataFrame:
    """The row of the model with the highest AUC (first by name on ties)."""
    rank = W.partitionBy().orderBy(F.desc_nulls_last("auc"), model)  # one row per model
    return metrics.withColumn("_r", F.row_number().over(rank)).filter("_r = 1").drop("_r")


def class_weight(df: DataFrame, target: str = "target") -> DataFrame:
    """``pos``, ``neg`` and ``pos_weight`` = negatives per positive."""
    counts = df.agg(F.count_if(F.col(target) == 1).alias("pos"),
                    F.count_if(F.col(target) == 0).alias("neg"))
    return counts.withColumn("pos_weight", F.col("neg") / F.greatest(F.col("pos"), F.lit(1)))
