"""Clusters against all exact distances in plain Python."""

import hashlib
import random
from math import floor, isfinite

import numpy as np
import pytest

from lossloom.llm import pivot_clusters as p


def plain(rows, s=p.DEFAULT):
    kept = [(i, [floor(s.scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == s.dims and all(x is not None and isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(
        f"{s.prefix}{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centers = [v for _, v in order[:s.k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k)
                   for k, c in enumerate(centers))

    for _ in range(s.rounds):
        own = [near(v)[1] for _, v in kept]
        centers = [[sum(x) // len(x) for x in zip(*m, strict=True)] if (
            m := [v for (_, v), k in zip(kept, own, strict=True) if k == c]) else old
            for c, old in enumerate(centers)]
    last = [near(v) for _, v in kept]
    return sorted((str(i), k, d, sum(x for x, y in last if y == k), sum(x for x, _ in last),
                   hashlib.sha256(",".join(map(str, centers[k])).encode()).hexdigest())
                  for (i, _), (d, k) in zip(kept, last, strict=True))


def got(df, key="vec_id"):
    return sorted((str(r[key]), r.cluster, r.distance, r.cluster_inertia, r.inertia,
                   r.centroid_sha256) for r in df.collect())


def sample(n=150):
    r = random.Random(7)
    rows = [(i, [r.gauss((i % 5) / 4, .3) for _ in range(64)]) for i in range(n)]
    rows += [(n, rows[3][1]), (3, rows[3][1]), (None, rows[4][1]), (n + 1, [0.0] * 64),
             (n + 2, [-0.0] * 63), (n + 3, [1.0] * 65), (n + 4, None), (n + 5, [None] + [1.0] * 63),
             (n + 6, [float("nan")] * 64), (n + 7, [float("inf")] + [0.0] * 63), (n + 8, [])]
    return rows + [(n + 9, [-1e-9] * 64)] * 4


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows],
                                 f"vec_id long, embedding array<{kind}>, v int, cluster int")


@pytest.mark.parametrize("n", [150, 5])
def test_rounds_match_plain_distances(spark, n):
    rows = sample(n)
    assert got(p.cluster_vectors(frame(spark, rows).repartition(4))) == plain(rows)


def test_equal_distances_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    s = p.Settings(k=3, rounds=2, dims=1, scale=1, pivots=2)
    for rows in ([(i, [float(x)]) for i, x in enumerate((0, 2, 4, 1, 3, 1, 3))],
                 [(i, [5.0]) for i in range(9)]):
        assert got(p.cluster_vectors(frame(spark, rows), settings=s)) == plain(rows, s)


def test_too_large_components_and_empty_tables(spark):
    rows = [(1, [1e300] * 64), (2, [1.0] * 64)]
    assert [r.vec_id for r in p.cluster_vectors(frame(spark, rows)).collect()] == [2]
    none = p.cluster_vectors(frame(spark, rows[:1]))
    assert none.count() == 0 and none.columns == p.cluster_vectors(frame(spark, rows)).columns
    top = float(p.LIMIT // 1024 - 1)
    far = [(1, [top] * 64), (2, [-top] * 64), (3, [0.0] * 64)]
    assert got(p.cluster_vectors(frame(spark, far))) == plain(far)


def test_bounds_discard_but_never_a_nearest_centroid():
    r = np.random.default_rng(2)
    v = np.concatenate([r.normal(c, 40, (200, 64)) for c in (0, 300, 600, 900)]).astype(np.int64)
    pivots = p.choose_pivots(v[:256], 16)
    centers = v[[5, 250, 420, 700, 10, 630]]
    marks, table = p.pivot_distances(centers, pivots), p.pivot_distances(v, pivots)
    label, best, measured = p.nearest(v, table.astype(np.float32), centers, marks)
    every = np.stack([p.squared(v, c) for c in centers], axis=1)
    assert (label == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert measured < 0.5 * every.size
    assert (p.lower_bounds(table, marks) <= np.sqrt(every)).all()
