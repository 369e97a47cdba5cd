"""Clusters of integer vectors around moving centroids, by a LAESA pivot table.

Every vector is stored once beside its distances to fixed pivots. In a round the distances of the
centroids to the pivots are known too, and by the triangle inequality no centroid is nearer to a
vector than the largest difference of their coordinates. The centroid with the least such bound
is measured first, exactly, in whole numbers; others are measured only if their bound does not
exceed the best distance so far. The bounds are taken with a margin for rounding, so they
never change a result.

A round reads the stored table, sums the vectors of each cluster inside the tasks and sends one row
per task and cluster; the driver gets k sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    FloatType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from lossloom.llm.storage import stored

#: Whole components stay below this, so that squared distances of 64 of them fit 64 bits.
LIMIT = 1 << 27
SLACK = 1e-6


@dataclass(frozen=True)
class Settings:
    """Clusters, rounds, components, scale to whole numbers, prefix of the hashed ids, pivots, and
    the vectors (those of smallest hash) among which pivots are chosen; pivots only affect speed."""
    k: int = 8
    rounds: int = 10
    dims: int = 64
    scale: int = 1024
    prefix: str = "3:"
    pivots: int = 16
    pivot_pool: int = 256


DEFAULT = Settings()


def whole_vectors(table: DataFrame, vec_id: str, vector: str, settings: Settings) -> DataFrame:
    """(id, v) of the vectors kept: floor(scale * x) of every component."""
    x = F.col(vector).cast("array<double>")
    fit = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c)
                   & (F.abs(c) < F.lit(float(LIMIT // settings.scale))))
    return table.filter((F.size(x) == settings.dims) & fit).select(
        F.col(vec_id).alias("id"),
        F.transform(x, lambda c: F.floor(c * F.lit(float(settings.scale))).cast("int")).alias("v"))


def first_vectors(vectors: DataFrame, n: int, settings: Settings) -> np.ndarray:
    """The ``n`` vectors of smallest hash of prefix and id; null ids last, ties by components."""
    h = F.sha2(F.concat(F.lit(settings.prefix), F.col("id").cast("string")), 256)
    rows = vectors.withColumn("h", h).orderBy(F.asc_nulls_last("h"), "v").limit(n).select("v")
    return np.array([r["v"] for r in rows.collect()], np.int64).reshape(-1, settings.dims)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    gap = v - c
    return np.einsum("ij,ij->i", gap, gap)


def pivot_distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(v, p) for p in pivots], axis=1).astype(float))


def choose_pivots(pool: np.ndarray, n: int) -> np.ndarray:
    """Vectors of the pool, each the farthest from those before it."""
    chosen, nearest = [pool[0]], squared(pool, pool[0])
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(pool[nearest.argmax()])
        nearest = np.minimum(nearest, squared(pool, chosen[-1]))
    return np.array(chosen)


def lower_bounds(table: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """(vectors, centroids): largest coordinate difference less a margin for rounding."""
    return np.stack([(np.abs(table - m) - SLACK * (table + m + 1)).max(axis=1) for m in marks],
                    axis=1)


def nearest(v: np.ndarray, table: np.ndarray, centroids: np.ndarray,
            marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: smaller number), its squared distance, and distances computed."""
    bounds = lower_bounds(table, marks)
    label = bounds.argmin(axis=1)
    first = label.copy()
    best = squared(v, centroids[label])
    measured = len(v)
    for c in range(len(centroids)):
        live = np.flatnonzero((first != c) & (bounds[:, c] <= np.sqrt(best) * (1 + SLACK)))
        d = squared(v[live], centroids[c])
        measured += len(live)
        better = (d < best[live]) | ((d == best[live]) & (c < label[live]))
        best[live[better]], label[live[better]] = d[better], c
    return label, best, measured


def matrix(batch: pa.RecordBatch, name: str, kind) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` (id, v) with ``table``, their distances to the pivots, stored once."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            t = pivot_distances(matrix(b, "v", np.int64), pivots).astype(np.float32)
            ends = np.arange(0, t.size + 1, len(pivots), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.ListArray.from_arrays(ends, pa.array(t.ravel()))],
                names=[*b.schema.names, "table"])

    schema = StructType([*vectors.schema.fields, StructField("table", ArrayType(FloatType()))])
    return stored(vectors.mapInArrow(measure, schema))


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Centroids after one round: exact floors of the means; empty ones stay."""
    marks = pivot_distances(centroids, pivots)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for b in batches:
            if not len(b):
                continue
            v = matrix(b, "v", np.int64)
            label, _, _ = nearest(v, matrix(b, "table", float), centroids, marks)
            for c in np.unique(label):
                own = label == c
                n[c] += own.sum()
                sums[c] += v[own].sum(axis=0)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({
            "c": pa.array(used.astype(np.int32)), "n": pa.array(n[used]),
            "s": pa.array(list(sums[used]), pa.list_(pa.int64()))})

    parts = table.select("v", "table").mapInArrow(add, "c int, n long, s array<long>")
    dims = range(centroids.shape[1])
    rows = parts.groupBy("c").agg(F.sum("n").alias("n"), F.array(
        *(F.sum(F.get("s", F.lit(i)).cast("decimal(38,0)")) for i in dims)).alias("s")).collect()
    out = centroids.copy()
    for r in rows:
        out[r["c"]] = [int(x) // r["n"] for x in r["s"]]
    return out


@dataclass
class Clusters:
    """What a fit gives: the stored pivot table, the pivots and the final centroids."""
    table: DataFrame
    pivots: np.ndarray
    centroids: np.ndarray


def fit(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
        settings: Settings = DEFAULT) -> Clusters | None:
    """Run all rounds; None if no vector is kept. Fewer than k vectors give fewer centroids."""
    vectors = whole_vectors(table, vec_id, vector, settings)
    pool = first_vectors(vectors, max(settings.pivot_pool, settings.k), settings)
    if not len(pool):
        return None
    pivots = choose_pivots(pool, settings.pivots)
    rows = pivot_table(vectors, pivots)
    centroids = pool[:settings.k]
    for _ in range(settings.rounds):
        centroids = moved(rows, centroids, pivots)
    return Clusters(rows, pivots, centroids)


def assigned(found: Clusters) -> DataFrame:
    """(id, cluster, distance): nearest final centroid and squared distance of every vector."""
    centroids, pivots = found.centroids, found.pivots
    marks = pivot_distances(centroids, pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                label, best, _ = nearest(matrix(b, "v", np.int64), matrix(b, "table", float),
                                         centroids, marks)
                yield pa.RecordBatch.from_arrays(
                    [b.column(b.schema.get_field_index("id")), pa.array(label.astype(np.int32)),
                     pa.array(best)], names=["id", "cluster", "distance"])

    schema = StructType([found.table.schema["id"], StructField("cluster", IntegerType()),
                         StructField("distance", LongType())])
    return found.table.mapInArrow(assign, schema)


def cluster_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                    settings: Settings = DEFAULT) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: a row per vector kept.

    Vectors of another size, null vectors, and vectors with a component that is null, not finite
    or at least 2^27 / scale (its distances would not fit 64 bits) are left out. A null id hashes
    last; repeated rows are vectors of their own; equal hashes are ordered by components; equal
    distances go to the smaller number. An empty table gives no rows; other columns do not matter.
    """
    found = fit(table, vec_id, vector, settings)
    if found is None:
        return table.filter(F.lit(False)).select(
            vec_id, *(F.lit(None).cast(kind).alias(c) for c, kind in (
                ("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"),
                ("inertia", "long"), ("centroid_sha256", "string"))))
    rows = stored(assigned(found))
    per = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = per.agg(F.sum("cluster_inertia")).first()[0]
    names = F.array(*(F.sha2(F.lit(",".join(map(str, c))).cast("binary"), 256)
                      for c in found.centroids))
    return rows.join(F.broadcast(per), "cluster").select(  # one row per cluster
        F.col("id").alias(vec_id), "cluster", "distance", "cluster_inertia",
        F.lit(total).cast("long").alias("inertia"),
        F.get(names, F.col("cluster")).alias("centroid_sha256"))


def oracle(settings: Settings = DEFAULT, embeddings: str = "embeddings") -> str:
    """All rounds in plain SQL: every distance, no bound."""
    s = settings
    steps = []
    for r in range(s.rounds + 1):
        steps.append(f"""
near{r} as materialized (
  select id, arg_min(c, (d, c)) as c, min(d) as d from (
    select v.id, m.c, sum((v.x - m.x) * (v.x - m.x)) as d
    from parts v join center{r} m on v.i = m.i group by v.id, m.c) group by id)""")
        if r < s.rounds:
            steps.append(f"""
center{r + 1} as materialized (
  select m.c, m.i, coalesce((t.s - ((t.s % t.n) + t.n) % t.n) // t.n, m.x) as x
  from center{r} m left join (
    select near{r}.c, v.i, sum(v.x) as s, count(*) as n from parts v join near{r} using (id)
    group by near{r}.c, v.i) t on t.c = m.c and t.i = m.i)""")
    last = s.rounds
    return f"""
with kept as materialized (
  select row_number() over () as id, vec_id,
         list_transform(embedding, lambda x: cast(floor({s.scale} * cast(x as double)) as bigint)) as v
  from {embeddings}
  where len(embedding) = {s.dims}
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {s.dims}),
parts as materialized (
  select id, unnest(range(1, {s.dims + 1})) as i, unnest(v) as x from kept),
ranked as (
  select id, row_number() over (order by sha256('{s.prefix}' || vec_id), v) - 1 as c from kept),
center0 as materialized (
  select r.c, p.i, p.x from ranked r join parts p using (id) where r.c < {s.k}),{",".join(steps)},
names as (
  select c, sha256(string_agg(cast(x as varchar), ',' order by i)) as centroid_sha256
  from center{last} group by c)
select k.vec_id, cast(a.c as int) as cluster, cast(a.d as bigint) as distance,
       cast(sum(a.d) over (partition by a.c) as bigint) as cluster_inertia,
       cast(sum(a.d) over () as bigint) as inertia, n.centroid_sha256
from near{last} a join kept k using (id) join names n on n.c = a.c"""
