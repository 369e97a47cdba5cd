"""Isotonic regression as the lower convex hull of running totals, on the cluster.

With scores in order, let X be the running number of rows and Y the running sum of the target. The
pools of the isotonic fit are the edges of the lower convex hull of the points (X, Y), and their
slopes are the fitted rates. Scores are cut into ranges. Each range pools its own values in one pass
(adjacent violators, at most one pool per value); what is left is to find the hull edges that
bridge range borders. There is at most one bridge per border:

* the hull of the border points and of the pool ends next to them gives the first bridges;
* every range that a bridge touches reports its point farthest below the line of the bridge;
* these points refine the hull, and only edges that cross a border are asked for again.

A range is touched by two bridges at most, and a line that no point of its ranges is below is final.

So the driver holds counts per range and at most one edge per border, while the pools, of which there
can be as many as distinct scores, stay stored on the cluster.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.functions.bounds import clip, no_nan

from .durable import durable
from .ranks import SLICE, cut_into_slices, running_totals, value_counts

#: Models of up to so many pools travel to the workers; larger ones are joined by groups of pools.
SENT_POOLS = 100_000
POOL = "lo double, hi double, n double, s double"


def pooled_ranges(sliced: DataFrame, score: str, total: str) -> DataFrame:
    """Pools of every range on its own, in order: (_slice, lo, hi, n, s, x, y); x and y are running
    totals within the range up to the end of the pool."""
    def pool(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack: list[list[float]] = []
        current = None

        def finished() -> pd.DataFrame:
            out = pd.DataFrame(stack, columns=["lo", "hi", "n", "s"])
            out["x"], out["y"] = out["n"].cumsum(), out["s"].cumsum()
            out.insert(0, SLICE, current)
            return out

        for batch in batches:
            for part, v, n, s in zip(batch[SLICE], batch[score], batch["n"], batch[total],
                                     strict=True):
                if part != current:
                    if stack:
                        yield finished()
                    stack, current = [], part
                top = [v, v, float(n), float(s)]
                while stack and stack[-1][3] * top[2] >= top[3] * stack[-1][2]:
                    lo, _, m, t = stack.pop()
                    top = [lo, top[1], m + top[2], t + top[3]]
                stack.append(top)
        if stack:
            yield finished()

    rows = sliced.select(SLICE, score, "n", total).sortWithinPartitions(SLICE, score)
    return durable(rows.mapInPandas(pool, f"{SLICE} int, {POOL}, x double, y double"))


def lower_hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Corners of the lower convex hull of points, by x."""
    hull: list[tuple[float, float]] = []
    for p in sorted(set(points)):
        while len(hull) > 1 and ((hull[-1][1] - hull[-2][1]) * (p[0] - hull[-2][0])
                                 >= (p[1] - hull[-2][1]) * (hull[-1][0] - hull[-2][0])):
            hull.pop()
        hull.append(p)
    return hull


def crossing(hull: list[tuple[float, float]], borders: list[float]) -> list[tuple]:
    """Edges (x0, y0, x1, y1) of the hull with a border strictly inside."""
    out = []
    for (x0, y0), (x1, y1) in zip(hull, hull[1:], strict=False):
        at = bisect_right(borders, x0)
        if at < len(borders) and borders[at] < x1:
            out.append((x0, y0, x1, y1))
    return out


def below(pools: DataFrame, bridges: list[tuple], borders: list[float],
          slack: float) -> list[tuple[float, float]]:
    """Per bridge the pool end farthest below its line, if any is: at most one point per bridge.

    All points of the ranges that a bridge touches are looked at, also those beyond its ends.
    """
    x0, y0, x1, y1 = np.array(bridges).T
    slope = (y1 - y0) / (x1 - x0)
    first = np.searchsorted(borders, x0, side="right")
    last = np.searchsorted(borders, x1, side="left")
    # The last bridge that begins in or before a range, and the first that ends in or after it.
    ranges = np.arange(len(borders) + 1)
    begun = np.searchsorted(first, ranges, side="right") - 1
    ending = np.searchsorted(last, ranges, side="left")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            k, x, y = (b[c].to_numpy() for c in ("k", "X", "Y"))
            for e in (begun[k], ending[k]):
                at = np.clip(e, 0, len(slope) - 1)
                touched = (first[at] <= k) & (k <= last[at])
                gap = y - y0[at] - slope[at] * (x - x0[at])
                found = pd.DataFrame({"e": at, "gap": gap, "x": x, "y": y})[touched & (gap < -slack)]
                yield found.sort_values("gap").drop_duplicates("e")

    found = pools.select("k", "X", "Y").mapInPandas(search, "e long, gap double, x double, y double")
    rows = found.groupBy("e").agg(F.min_by(F.struct("x", "y"), "gap").alias("p")).collect()
    return [(r["p"]["x"], r["p"]["y"]) for r in rows]


def fit_pools(df: DataFrame, score: str, target: str, slices: int | None = None) -> DataFrame:
    """(lo, hi, n, s, value): scores from ``lo`` to ``hi`` form one pool of rate ``value``.

    Rows without a score or target are left out; an empty frame gives no pools.
    """
    known = df.filter(F.col(target).isNotNull()).select(
        F.col(score).cast("double").alias("v"), F.col(target).cast("double").alias("t"))
    sliced = cut_into_slices(value_counts(known, [], "v", _sum=F.col("t")), [], "v", slices)
    own = pooled_ranges(sliced, "v", "_sum")
    ends = own.groupBy(SLICE).agg(
        F.max("x").alias("x"), F.max_by("y", "x").alias("y"),
        F.min_by(F.struct("x", "y"), "x").alias("first"),
        F.max_by(F.struct("n", "s"), "x").alias("last")).orderBy(SLICE).collect()  # a row per range
    corners, offsets, points = [(0.0, 0.0)], [], []
    for k, r in enumerate(ends):
        x, y = corners[-1]
        offsets.append((r[SLICE], k, x, y))
        corners.append((x + r["x"], y + r["y"]))
        points.append((x + r["first"]["x"], y + r["first"]["y"]))
        points.append((corners[-1][0] - r["last"]["n"], corners[-1][1] - r["last"]["s"]))
    shift = df.sparkSession.createDataFrame(offsets, f"{SLICE} int, k int, _x double, _y double")
    pools = own.join(F.broadcast(shift), SLICE).select(
        "lo", "hi", "n", "s", "k", (F.col("x") + F.col("_x")).alias("X"),
        (F.col("y") + F.col("_y")).alias("Y"))
    borders = [x for x, _ in corners[1:-1]]
    slack = 1e-15 * max(1.0, *(abs(y) for _, y in corners))
    hull = lower_hull(corners + points)
    bridges = crossing(hull, borders)
    while bridges:
        refined = below(pools, bridges, borders, slack)
        if not refined:
            break
        hull = lower_hull(hull + refined)
        bridges = crossing(hull, borders)
    # Rates rise from pool to pool, so pools of one rate lie side by side (at a border): one pool.
    made = bridged(pools, bridges).withColumn("value", F.col("s") / F.col("n"))
    return durable(made.groupBy("value").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"),
        F.sum("s").alias("s")).select("lo", "hi", "n", "s", "value"))


def bridged(pools: DataFrame, bridges: list[tuple]) -> DataFrame:
    """Pools under a bridge become one; sums combine before they are shuffled."""
    if not bridges:
        return pools.select("lo", "hi", "n", "s")
    edges = np.array(bridges)

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            end = b["X"].to_numpy()
            e = np.searchsorted(edges[:, 0], end, side="left") - 1
            inside = (e >= 0) & (end <= edges[e.clip(0), 2])
            yield b[["lo", "hi", "n", "s"]].assign(e=np.where(inside, e, -1))

    marked = pools.mapInPandas(number, f"{POOL}, e long")
    one = marked.filter("e >= 0").groupBy("e").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"),
        F.sum("s").alias("s"))
    return marked.filter("e < 0").drop("e").unionByName(one.drop("e"))


def interpolated(df: DataFrame, score: str, pools: DataFrame, out: str,
                 sent: int = SENT_POOLS) -> DataFrame:
    """``df`` with ``out``: the rate of the pool of each score, linear between pools, flat outside.

    A null score gives null. Up to ``sent`` pools travel to the workers. More are numbered and cut
    into ``sent`` groups at most; workers get the first score of each group, and rows meet the
    pools of their group in a join, where no row looks at more than one group.
    """
    n = pools.count()
    if n == 0:
        return df.withColumn(out, F.lit(None).cast("double"))
    spark = df.sparkSession
    if n <= sent:
        rows = pools.orderBy("lo").select("lo", "hi", "value").toPandas()
        shared = spark.sparkContext.broadcast(rows.to_numpy())

        @F.pandas_udf("double")
        def curve(x: pd.Series) -> pd.Series:
            lo, hi, v = shared.value.T
            keep = np.ravel(np.column_stack((np.ones(len(lo), bool), hi > lo)))
            knots = np.ravel(np.column_stack((lo, hi)))[keep]
            y = np.interp(x.to_numpy(float), knots, np.repeat(v, 2)[keep])
            return pd.Series(y).where(x.notna().to_numpy())

        return df.withColumn(out, curve(F.col(score).cast("double")))
    one = pools.select("lo", "hi", "value", F.lit(1).alias("one"))
    ranked = running_totals(cut_into_slices(one, [], "lo"), [], "lo", ["one"], {
        "next_lo": ("lo", "lead"), "next_value": ("value", "lead")})
    size = -(-n // sent)
    parts = durable(ranked.select(
        F.floor(F.col("one_before") / size).cast("int").alias("_iso_group"),
        F.when(F.col("one_before") > 0, F.col("lo")).alias("_iso_from"),
        F.col("hi").alias("_iso_hi"), F.col("value").alias("_iso_value"),
        F.col("next_lo").alias("_iso_next"), F.col("next_value").alias("_iso_after")))
    starts = [r[0] for r in parts.groupBy("_iso_group").agg(F.min("_iso_from").alias("v")).orderBy(
        "_iso_group").select("v").collect()]
    shared = spark.sparkContext.broadcast(np.array(starts[1:], float))

    @F.pandas_udf("int")
    def group_of(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, x.to_numpy(float), side="right")).astype(
            "int32").where(x.notna().to_numpy())

    x = F.col("_iso_x")
    rows = df.withColumn("_iso_x", no_nan(F.col(score).cast("double"))).withColumn(
        "_iso_g", group_of("_iso_x"))
    own = (F.col("_iso_g") == F.col("_iso_group")) & (
        F.col("_iso_from").isNull() | (x >= F.col("_iso_from"))) & (
        F.col("_iso_next").isNull() | (x < F.col("_iso_next")))
    share = (x - F.col("_iso_hi")) / (F.col("_iso_next") - F.col("_iso_hi"))
    value = F.when((x <= F.col("_iso_hi")) | F.col("_iso_next").isNull(), F.col("_iso_value")).otherwise(
        F.col("_iso_value") + (F.col("_iso_after") - F.col("_iso_value")) * share)
    return rows.join(parts, own, "left").select(*df.columns, value.alias(out))


@dataclass
class Calibrator:
    """Monotone map from score to observed rate, linear between its pools, flat outside."""

    pools: DataFrame

    def apply(self, df: DataFrame, score: str, out: str, sent: int = SENT_POOLS) -> DataFrame:
        fitted = interpolated(df, score, self.pools, "_iso_fit", sent)
        return fitted.withColumn(out, clip(F.col("_iso_fit"), 0.0, 1.0)).drop("_iso_fit")


def fit_calibrator(scored: DataFrame, score: str, target: str,
                   slices: int | None = None) -> Calibrator:
    """Isotonic regression of ``target`` on ``score``; tied scores count as one point."""
    return Calibrator(fit_pools(scored, score, target, slices))
