"""Macro scenarios mapped to point-in-time default probabilities.

Tables here have scenarios x months rows; they are built by exploding one baseline row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.functions.normal import point_in_time_pd
from lossloom.operators.regression import LinearFit
from lossloom.params import ScenarioSettings


def ramp(month: Column, months: int) -> Column:
    """Share of the peak shock reached in a month: linear up to ``months``, then 1."""
    return F.least(F.greatest(month / F.lit(float(max(months, 1))), F.lit(0.0)), F.lit(1.0))


def macro_paths(baseline: DataFrame, features: list[str],
                s: ScenarioSettings = ScenarioSettings()) -> DataFrame:
    """``scenario, weight, month, <features>``: baseline plus ramped peak shock."""
    cases = F.array(*[
        F.struct(F.lit(name).alias("scenario"), F.lit(float(weight)).alias("weight"),
                 *[F.lit(float(s.shocks[name].get(f, 0.0))).alias(f"_peak_{f}")
                   for f in features])
        for name, weight in s.weights.items()])
    rows = baseline.select(*features, F.explode(cases).alias("c")).select(
        *features, "c.*", F.explode(F.sequence(F.lit(1), F.lit(s.horizon))).alias("month"))
    share = ramp(F.col("month"), s.ramp)
    return rows.select("scenario", "weight", "month", *[
        (F.col(f) + F.col(f"_peak_{f}") * share).alias(f) for f in features])


def factor_paths(baseline: DataFrame, fit: LinearFit,
                 s: ScenarioSettings = ScenarioSettings()) -> DataFrame:
    """``scenario, weight, month, z`` from the macro regression, or as an overlay on its baseline."""
    features = list(fit.features)
    if s.mode == "macro":
        return macro_paths(baseline, features, s).select(
            "scenario", "weight", "month", fit.column().alias("z"))
    cases = F.array(*[
        F.struct(F.lit(name).alias("scenario"), F.lit(float(weight)).alias("weight"),
                 F.lit(float(s.z_overlay[name])).alias("_shift"))
        for name, weight in s.weights.items()])
    return baseline.select(fit.column().alias("_z"), F.explode(cases).alias("c")).select(
        "c.scenario", "c.weight",
        F.explode(F.sequence(F.lit(1), F.lit(s.horizon))).alias("month"),
        (F.col("_z") + F.col("c._shift")).alias("z"))


def ordered_factors(paths: DataFrame) -> DataFrame:
    """Clamp every month to downside <= base <= upside; ``adjusted`` tells whether that changed z.

    A change counts beyond a relative 1e-5 or absolute 1e-8. Unchanged when one of the three
    scenarios is missing.
    """
    wide = paths.groupBy("month").agg(
        F.max(F.when(F.col("scenario") == "base", F.col("z"))).alias("_base"),
        F.collect_set("scenario").alias("_names"),
        F.collect_list(F.struct("scenario", "weight", "z")).alias("_rows"))  # one per scenario
    complete = reduce(lambda a, b: a & b, [F.array_contains("_names", n)
                                           for n in ("base", "upside", "downside")])
    z, name = F.col("r.z"), F.col("r.scenario")
    clamped = (F.when(~F.col("_complete"), z)
               .when(name == "downside", F.least(z, F.col("_base")))
               .when(name == "upside", F.greatest(z, F.col("_base"))).otherwise(z))
    rows = wide.withColumn("_complete", complete).select(
        "month", "_base", "_complete", F.explode("_rows").alias("r"))
    out = rows.select(name.alias("scenario"), F.col("r.weight").alias("weight"), "month",
                      clamped.alias("z"), z.alias("_old"))
    moved = F.abs(F.col("z") - F.col("_old")) > 1e-8 + 1e-5 * F.abs(F.col("_old"))
    return out.select("scenario", "weight", "month", "z", moved.alias("adjusted"))


def default_paths(paths: DataFrame, ttc_pd: Column, rho: float) -> DataFrame:
    """Add ``pit_pd`` to factor paths; ``ttc_pd`` may be a scalar subquery."""
    known = paths.withColumn("_ttc", ttc_pd)
    return known.withColumn("pit_pd", point_in_time_pd(F.col("_ttc"), F.col("z"), rho)).drop("_ttc")


def weighted_path(paths: DataFrame) -> DataFrame:
    """``month, weighted_pit_pd``: probability-weighted over the scenarios."""
    return paths.groupBy("month").agg(
        F.sum(F.col("weight") * F.col("pit_pd")).alias("weighted_pit_pd"))


def ordering_check(paths: DataFrame, month: int = 12) -> DataFrame:
    """Is downside >= base >= upside in ``month`` (or the last month if the paths are shorter)?"""
    last = paths.agg(F.least(F.max("month"), F.lit(month)).alias("m")).scalar()

    def at(name: str, fallback: float) -> Column:
        value = F.max(F.when(F.col("scenario") == name, F.col("pit_pd")))
        return F.coalesce(value, F.lit(fallback))

    return paths.filter(F.col("month") == last).agg(
        at("base", 0.0).alias("base"), at("upside", 0.0).alias("upside"),
        at("downside", 1.0).alias("downside")).withColumn(
        "ordering_ok",
        (F.col("downside") >= F.col("base")) & (F.col("base") >= F.col("upside")))


def multipliers(paths: DataFrame) -> DataFrame:
    """``scenario, month, multiplier``: path over the weighted month-1 level, so the book keeps it."""
    anchor = paths.filter(F.col("month") == 1).agg(
        F.sum(F.col("weight") * F.col("pit_pd")).alias("a")).scalar()
    return paths.select("scenario", "weight", "month",
                        (F.col("pit_pd") / F.nullif(anchor, F.lit(0.0))).alias("multiplier"))
