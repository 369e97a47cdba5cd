"""Exact running totals and quantiles over ordered values, without a single-task sort.

Rows are first collapsed to one row per distinct value (map-side combined, so a value or group
holding a large share of the rows costs nothing extra). The distinct values are then cut into
contiguous ranges; each range is summed and accumulated on its own, and only the per-range
totals (ranges x groups) are accumulated in one place. No group is ever held by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .durable import durable, small_side

SLICE = "_slice"


def value_counts(df: DataFrame, by: Sequence[str], value: str, keep_nulls: bool = False,
                 **sums: Column) -> DataFrame:
    """One row per group and distinct value, with row count ``n`` and further sums.

    Null values are left out, or kept as one row per group with ``n`` = 0 so that a group without
    any value stays visible.
    """
    keys = [F.col(c) for c in by]
    clean = F.col(value).cast("double")
    clean = F.when(~F.isnan(clean), clean + F.lit(0.0)).alias(value)  # also -0.0 -> 0.0
    terms = {name: expr.alias(name) for name, expr in sums.items()}
    rows = df.select(*keys, clean, *terms.values())
    if not keep_nulls:
        rows = rows.filter(F.col(value).isNotNull())
    return rows.groupBy(*by, value).agg(
        F.count(value).alias("n"), *[F.sum(name).alias(name) for name in terms])


FEW_VALUES = 1000
SKETCH = 2000  # rank error of the sketch is at most rows / SKETCH


def sketch_of(value: str, probabilities: Sequence[float]) -> Column:
    """Aggregate: the limits of a narrow interval around each wanted quantile, lows then highs."""
    margin = 4.0 / SKETCH
    lows = [max(p - margin, 0.0) for p in probabilities]
    highs = [min(p + margin, 1.0) for p in probabilities]
    return F.percentile_approx(value, [*lows, *highs], SKETCH)


def compact_counts(df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float],
                   keep_nulls: bool = False, sketch: DataFrame | None = None,
                   **sums: Column) -> DataFrame:
    """:func:`value_counts` with the values that cannot be a wanted quantile merged into cells.

    A first pass sketches, per group, a narrow interval around each wanted quantile. The second
    pass keeps the values inside the intervals and merges those between two intervals into one
    row (its smallest value stands for it), so a column of distinct doubles shuffles a few rows
    per thousand instead of all. Groups with few distinct values keep all of them. Merged rows
    have ``exact`` = false; :func:`all_exact` tells whether a wanted rank fell on one. ``sketch``
    (``by``, ``_q`` from :func:`sketch_of`, ``_few``) saves the first pass if it is known already.
    """
    keys = [F.col(c) for c in by]
    clean = F.col(value).cast("double")
    clean = F.when(~F.isnan(clean), clean + F.lit(0.0)).alias(value)
    rows = df.select(*keys, clean, *[e.alias(n) for n, e in sums.items()])
    if not keep_nulls:
        rows = rows.filter(F.col(value).isNotNull())
    if sketch is None:
        sketch = rows.groupBy(*by).agg(
            sketch_of(value, probabilities).alias("_q"),
            (F.approx_count_distinct(value) <= FEW_VALUES).alias("_few"))
    n = len(probabilities)
    x, q = F.col(value), F.col("_q")
    # Both ends rise with the interval, so a value can only be in the first one that does not end below it.
    # Few conditions, counted once: more make a method that is too long to be compiled.
    ended = F.lit(0)
    for i in range(n):
        ended = ended + F.when(x > F.get(q, F.lit(n + i)), 1).otherwise(0)
    cell = F.col("_ended")
    inside = F.coalesce(F.col("_few"), F.lit(True)) | (
        (cell < n) & (x >= F.get(q, F.when(cell < n, cell))))
    if by:
        joined = rows.join(small_side(sketch), list(by))
    else:
        joined = rows.withColumns({c: sketch.select(c).scalar() for c in ("_q", "_few")})
    placed = joined.withColumn("_ended", ended).withColumn("_inside", inside).withColumns({
        "_kept": F.when(F.col("_inside") | x.isNull(), x),
        "_cell": F.when(x.isNull(), F.lit(-1)).when(F.col("_inside"), F.lit(None)).otherwise(cell)})
    merged = placed.groupBy(*by, "_cell", "_kept").agg(
        F.count(value).alias("n"), F.min(value).alias("_min"), F.max(value).alias("_max"),
        *[F.sum(name).alias(name) for name in sums])
    return merged.select(*by, F.col("_min").alias(value), "n", *sums,
                         F.coalesce(F.col("_min") == F.col("_max"), F.lit(True)).alias("exact"))


def all_exact(ranked: DataFrame, probabilities: Sequence[float]) -> bool:
    """Did every wanted rank fall on a value that was kept as it is?"""
    first, last = F.col("n_before"), F.col("n_before") + F.col("n") - 1
    hit = F.lit(False)
    for p in probabilities:
        position = (F.col("n_total") - 1) * F.lit(float(p))
        for rank in (F.floor(position), F.ceil(position)):
            hit = hit | ((first <= rank) & (rank <= last))
    return ranked.filter(~F.col("exact") & hit).isEmpty()


def ranked_counts(df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float],
                  keep_nulls: bool = False, sketch: DataFrame | None = None,
                  **sums: Column) -> tuple[DataFrame, DataFrame]:
    """Stored slices and their running totals, compacted where that is exact, else complete."""
    sliced = cut_into_slices(
        compact_counts(df, by, value, probabilities, keep_nulls, sketch, **sums), by, value)
    ranked = running_totals(sliced, by, value, ["n"])
    if not all_exact(ranked, probabilities):
        sliced = cut_into_slices(value_counts(df, by, value, keep_nulls, **sums), by, value)
        ranked = running_totals(sliced, by, value, ["n"])
    return sliced, ranked


def cut_into_slices(counts: DataFrame, by: Sequence[str], value: str,
                    slices: int | None = None) -> DataFrame:
    """Add a ``_slice`` number that follows (group, value) order and is stored with the rows."""
    slices = slices or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return durable(
        counts.repartitionByRange(slices, *by, value).withColumn(SLICE, F.spark_partition_id())
    )


def running_totals(sliced: DataFrame, by: Sequence[str], value: str, sums: Sequence[str],
                   edges: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Add ``<s>_before`` (total of smaller values) and ``<s>_total`` for each column in ``sums``.

    ``edges`` adds look-ahead columns: ``{"next_n": ("n", "lead")}`` or ``lag`` of the neighbour
    in value order, also across slice borders.
    """
    edges = edges or {}
    keys = list(by)
    per_slice = [F.sum(s).alias(f"_in_{s}") for s in sums]
    for name, (source, side) in edges.items():
        pick = F.min_by if side == "lead" else F.max_by
        per_slice.append(pick(source, value).alias(f"_edge_{name}"))
    totals = sliced.groupBy(*keys, SLICE).agg(*per_slice)

    order = W.partitionBy(*keys).orderBy(SLICE)
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    everything = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    offsets = totals.select(
        *keys, SLICE,
        *[F.coalesce(F.sum(f"_in_{s}").over(earlier), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.sum(f"_in_{s}").over(everything).alias(f"{s}_total") for s in sums],
        *[(F.lead if side == "lead" else F.lag)(f"_edge_{name}").over(order).alias(f"_edge_{name}")
          for name, (_, side) in edges.items()],
    )

    local = W.partitionBy(*keys, SLICE).orderBy(value)
    before = local.rowsBetween(W.unboundedPreceding, -1)
    joined = sliced.join(offsets, [*keys, SLICE])
    return joined.select(
        *sliced.columns,
        *[(F.col(f"_off_{s}") + F.coalesce(F.sum(s).over(before), F.lit(0))).alias(f"{s}_before")
          for s in sums],
        *[F.col(f"{s}_total") for s in sums],
        *[F.coalesce((F.lead if side == "lead" else F.lag)(source).over(local),
                     F.col(f"_edge_{name}")).alias(name)
          for name, (source, side) in edges.items()],
    )


def quantiles_of_counts(ranked: DataFrame, by: Sequence[str], value: str,
                        probabilities: Sequence[float],
                        interpolation: str = "linear") -> DataFrame:
    """Exact quantiles from :func:`running_totals` over ``n``.

    Between two ranks they are interpolated ("linear") or take the value of the nearer one
    ("nearest", the upper one half way). Returns one row per group: ``n_total`` and the array ``quantiles``.
    """
    first, last = F.col("n_before"), F.col("n_before") + F.col("n") - 1
    picks = []
    for i, p in enumerate(probabilities):
        position = (F.col("n_total") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            hit = (first <= rank) & (rank <= last)
            picks.append(F.max(F.when(hit, F.col(value))).alias(f"_{side}{i}"))
    grouped = ranked.groupBy(*by).agg(F.max("n_total").alias("n_total"), *picks)
    values = []
    for i, p in enumerate(probabilities):
        position = (F.col("n_total") - 1) * F.lit(float(p))
        share = position - F.floor(position)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        values.append(lo + (hi - lo) * share if interpolation == "linear"
                      else F.when(share < 0.5, lo).otherwise(hi))
    return grouped.select(*by, "n_total", F.array(*values).alias("quantiles"))


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str,
                    probabilities: Sequence[float], sketch: DataFrame | None = None,
                    interpolation: str = "linear") -> DataFrame:
    """Exact quantiles of ``value`` per group; columns ``n_total`` and ``quantiles``."""
    if interpolation not in ("linear", "nearest"):
        raise ValueError(f"no interpolation {interpolation}")
    _, ranked = ranked_counts(df, by, value, probabilities, sketch=sketch)
    return quantiles_of_counts(ranked, by, value, probabilities, interpolation)


def bin_of(value: Column, edges: Column, bins: int) -> Column:
    """Left-closed bin number: how many of the inner edges are at or below the value."""
    inner = F.size(edges) - 2
    number = F.lit(0)
    for i in range(1, bins):
        number = number + F.when((F.lit(i) <= inner) & (value >= F.get(edges, F.lit(i))),
                                 1).otherwise(0)
    return F.when(value.isNotNull(), number)
