"""Isotonic pools on the cluster against adjacent violators in plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossloom.operators import isotonic as iso


def plain(rows):
    """(lo, hi, n, s) with rates that rise strictly."""
    points = {}
    for v, t in rows:
        if v is not None and t is not None:
            n, s = points.get(v, (0, 0))
            points[v] = (n + 1, s + t)
    stack = []
    for v, (n, s) in sorted(points.items()):
        top = [v, v, n, s]
        while stack and stack[-1][3] * top[2] >= top[3] * stack[-1][2]:
            lo, _, m, t = stack.pop()
            top = [lo, top[1], m + top[2], t + top[3]]
        stack.append(top)
    return [tuple(map(float, p)) for p in stack]


def shapes(kind, n, r):
    for i in range(n):
        v = round(r.random(), 3 if kind == "ties" else 9)
        p = {"rising": v, "falling": 1 - v, "flat": .3, "ties": v * v, "steps": int(v * 4) % 2,
             "zero": 0 if v < .6 else v, "last": v / 2 if v < .97 else 0}[kind]
        yield v, int(r.random() < p)


@pytest.mark.parametrize("kind", ["rising", "falling", "flat", "ties", "steps", "zero", "last"])
def test_pools_match_adjacent_violators(spark, kind):
    rows = list(shapes(kind, 3000, random.Random(kind)))
    rows += [(None, 1), (.5, None), (.25, 1), (.25, 0)]
    df = spark.createDataFrame(rows, "v double, y int")
    for slices in (1, 13):
        got = iso.fit_pools(df, "v", "y", slices).orderBy("lo").collect()
        assert [(r.lo, r.hi, r.n, r.s) for r in got] == plain(rows)
        assert all(r.value == r.s / r.n for r in got)


def test_driver_gets_only_counts_where_every_score_is_a_pool(spark, monkeypatch):
    """A strictly rising rate: as many pools as scores, none of them collected."""
    df = spark.range(40_000).select(F.col("id").cast("double").alias("v"),
                                    (F.col("id") / 40_000).alias("y"))
    seen = []
    plain_below = iso.below
    monkeypatch.setattr(iso, "below", lambda *a: seen.append(plain_below(*a)) or seen[-1])
    pools = iso.fit_pools(df, "v", "y", 20)
    assert pools.count() == 40_000 and sum(map(len, seen)) <= 20
    cal = iso.Calibrator(pools)
    for sent in (100_000, 500):
        out = cal.apply(df, "v", "c", sent)
        assert out.filter(F.abs(F.col("c") - F.col("y")) > 1e-12).count() == 0


@pytest.mark.parametrize("sent", [100_000, 7])
def test_rates_are_linear_between_pools_and_flat_outside(spark, sent):
    r = random.Random(2)
    train = [(v, int(r.random() < v ** 2)) for v in (round(r.random(), 2) for _ in range(4000))]
    pools = iso.fit_pools(spark.createDataFrame(train, "v double, y int"), "v", "y")
    want = plain(train)
    assert len(want) > 7
    xs = [-1.0, 2.0, None, float("nan"), *(r.random() for _ in range(500)), *(p[0] for p in want)]
    got = iso.Calibrator(pools).apply(
        spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "lo long, x double"), "x", "c", sent)
    assert got.columns == ["lo", "x", "c"]
    knots = [k for lo, hi, _, _ in want for k in ((lo, hi) if hi > lo else (lo,))]
    rates = [s / n for lo, hi, n, s in want for _ in range(2 if hi > lo else 1)]
    rows = got.collect()
    assert len(rows) == len(xs)
    for row in rows:
        if row.x is None or row.x != row.x:
            assert row.c is None
        else:
            assert abs(row.c - np.interp(row.x, knots, rates)) < 1e-12


def test_empty_frame_and_one_score(spark):
    none = spark.createDataFrame([], "v double, y int")
    assert iso.fit_pools(none, "v", "y").count() == 0
    assert iso.fit_calibrator(none, "v", "y").apply(none, "v", "c").columns == ["v", "y", "c"]
    one = spark.createDataFrame([(.5, 1), (.5, 0)], "v double, y int")
    assert [r.c for r in iso.fit_calibrator(one, "v", "y").apply(one, "v", "c").collect()] == [.5, .5]


def test_bridge_search_agrees_with_the_hull_of_all_points():
    r = np.random.default_rng(1)
    x = np.cumsum(r.integers(1, 5, 300)).astype(float)
    y = np.cumsum(r.integers(0, 3, 300)).astype(float)
    hull = iso.lower_hull([(0.0, 0.0), *zip(x, y, strict=True)])
    slopes = [(b[1] - a[1]) / (b[0] - a[0]) for a, b in zip(hull, hull[1:], strict=False)]
    assert slopes == sorted(slopes) and len(set(slopes)) == len(slopes)
