"""Least squares and logistic fits from one pass over the rows per step.

Linear: every task reduces its rows to the triangular factor of a QR decomposition, and factors are
stacked and reduced again in rounds of FAN, so the driver solves one small triangle. Unlike normal
equations this does not square the condition number, and collinear features get the solution of
least norm.

Logistic with folds: a step of iteratively reweighted least squares needs one weighted moment matrix
per fit. All fits (one per fold left out, and the one on all rows) take theirs in the same scan, so
k-fold cross-validation costs the scans of one fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.operators.durable import durable, durable_columns

FAN = 32


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])


def triangle(rows: DataFrame, columns: list[str]) -> tuple[np.ndarray, int]:
    """R factor of the matrix of a column of ones and ``columns`` (known numbers), and the row count."""
    width = len(columns) + 1
    kind = "part int, n long, r array<double>"

    def frame(part: int, n: int, r: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"part": [part], "n": [n], "r": [r.ravel()]})

    def stacked(blocks: list[np.ndarray]) -> np.ndarray:
        r = np.linalg.qr(np.vstack(blocks), mode="r")
        return np.vstack([r, np.zeros((width - len(r), width))])

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, n = np.zeros((width, width)), 0
        for b in batches:
            if len(b):
                r = stacked([r, np.column_stack((np.ones(len(b)), _matrix(b)))])
                n += len(b)
        if n:
            yield pa.RecordBatch.from_pandas(frame(0, n, r), schema=pa.schema(
                [("part", pa.int32()), ("n", pa.int64()), ("r", pa.list_(pa.float64()))]),
                preserve_index=False)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        r = stacked([np.array(x).reshape(width, width) for x in group["r"]])
        return frame(0, int(group["n"].sum()), r)

    known = rows.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    parts = durable(known.mapInArrow(reduce_rows, kind).withColumn("part", F.spark_partition_id()))
    left = parts.count()
    while left > FAN:
        # Partitions of one task each hold FAN factors or so, whatever their numbers are.
        spread = parts.withColumn("part", F.pmod(F.xxhash64("part", "n"), F.lit(-(-left // FAN))))
        merged = spread.withColumn("part", F.col("part").cast("int")).groupBy("part").applyInPandas(
            merge, kind)
        parts = durable(merged.withColumn("part", F.spark_partition_id()))
        left = parts.count()
    last = parts.collect()
    if not last:
        return np.zeros((width, width)), 0
    return stacked([np.array(x["r"]).reshape(width, width) for x in last]), sum(x["n"] for x in last)


def least_norm(r: np.ndarray, n: int) -> tuple[np.ndarray, float, float]:
    """Coefficients (least norm if not unique), intercept and R squared from the factor of (1, X, y).

    Below its first row the factor is that of the centred columns. They are scaled to unit length
    for the decision what is collinear, so badly scaled features are not mistaken for it.
    """
    inner = r[1:, 1:]
    x, y = inner[:, :-1], inner[:, -1]
    size = np.linalg.norm(x, axis=0)
    total = float(y @ y)
    used = size > 1e-12 * np.maximum(np.abs(r[0, 1:-1]), 1e-300)
    coefficients = np.zeros(x.shape[1])
    if used.any():
        scaled = x[:, used] / size[used]
        rank_cut = 1e-10
        values = np.linalg.svd(scaled, compute_uv=False)
        if values[-1] > rank_cut * values[0]:
            coefficients[used] = np.linalg.lstsq(scaled, y, rcond=None)[0] / size[used]
        else:
            coefficients[used] = np.linalg.lstsq(x[:, used], y, rcond=rank_cut)[0]
    means = r[0, 1:] / r[0, 0]
    missed = y - x @ coefficients
    r2 = 1 - float(missed @ missed) / total if total > 0 else 0.0
    return coefficients, float(means[-1] - means[:-1] @ coefficients), r2


@dataclass(frozen=True)
class FoldFits:
    """Coefficients per fold left out (last: on all rows), on standardised features, intercept first;
    the means and scales; rounds taken."""

    features: tuple[str, ...]
    coefficients: np.ndarray
    means: np.ndarray
    scales: np.ndarray
    rounds: int

    def scores(self, df: DataFrame, fold: str, out: str = "score") -> DataFrame:
        """``df`` with the probability by the fit that left out the fold of the row."""
        x = [(F.col(f).cast("double") - F.lit(float(m))) / F.lit(float(s))
             for f, m, s in zip(self.features, self.means, self.scales, strict=True)]
        table = F.array(*[F.array(*map(F.lit, map(float, b))) for b in self.coefficients])
        own = F.get(table, F.col(fold))
        z = F.get(own, F.lit(0))
        for i, v in enumerate(x):
            z = z + F.get(own, F.lit(i + 1)) * v
        return df.withColumn(out, 1 / (1 + F.exp(-z)))


def fit_folds(df: DataFrame, features: list[str], target: str, fold: str, folds: int,
              penalty: float = 1.0, tolerance: float = 1e-8, max_rounds: int = 50) -> FoldFits:
    """Logistic fits with an L2 ``penalty`` on standardised features, one per fold left out and one on
    all rows; every round is one scan that returns one moment matrix per fold.

    All values must be known. Rounds end when no coefficient moves by more than ``tolerance``.
    """
    p = len(features)
    moments = df.agg(*[F.avg(F.col(f).cast("double")) for f in features],
                     *[F.stddev_pop(F.col(f).cast("double")) for f in features]).first()
    means = np.array([m or 0.0 for m in moments[:p]])
    scales = np.array([s if s else 1.0 for s in moments[p:]])
    rows = durable_columns(df.select(
        F.col(fold).cast("int").alias("fold"), F.col(target).cast("double").alias("y"),
        *[F.col(f).cast("double").alias(f"c{i}") for i, f in enumerate(features)]))
    beta = np.zeros((folds + 1, p + 1))
    # A fit on all rows but those of fold k sums the matrices of all other folds; matrices differ by
    # fit, because the weights depend on its coefficients.
    for done in range(1, max_rounds + 1):
        grams, slopes = _moments(rows, beta, means, scales, folds)
        ridge = np.diag([0.0, *[penalty] * p])
        moved = 0.0
        for k in range(folds + 1):
            gradient = slopes[k] - ridge @ beta[k]
            step = np.linalg.lstsq(grams[k] + ridge, gradient, rcond=None)[0]
            beta[k] += step
            moved = max(moved, float(np.abs(step).max()))
        if moved < tolerance:
            break
    return FoldFits(tuple(features), beta, means, scales, done)


def _moments(rows: DataFrame, beta: np.ndarray, means: np.ndarray, scales: np.ndarray,
             folds: int) -> tuple[np.ndarray, np.ndarray]:
    """Weighted moment matrix and slope of every fit; a task sends one row, and Spark adds them by
    position, so the driver gets (folds + 1) small matrices."""
    size = beta.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, slope, seen = np.zeros((folds + 1, size, size)), np.zeros((folds + 1, size)), False
        for b in batches:
            if not len(b):
                continue
            seen = True
            m = _matrix(b)
            own, y = m[:, 0].astype(int), m[:, 1]
            x = np.column_stack((np.ones(len(m)), (m[:, 2:] - means) / scales))
            for k in range(folds + 1):
                used = own != k
                xk, yk = x[used], y[used]
                q = 1 / (1 + np.exp(-xk @ beta[k]))
                gram[k] += (xk * (q * (1 - q))[:, None]).T @ xk
                slope[k] += xk.T @ (yk - q)
        if seen:
            yield pa.RecordBatch.from_pydict({
                "v": pa.array([np.concatenate((gram.ravel(), slope.ravel()))], pa.list_(pa.float64()))})

    parts = rows.mapInArrow(add, "v array<double>")
    total = parts.select(F.posexplode("v").alias("i", "v")).groupBy("i").agg(
        F.sum("v").alias("v")).orderBy("i").collect()
    flat = np.array([r["v"] for r in total])
    cut = (folds + 1) * size * size
    return flat[:cut].reshape(folds + 1, size, size), flat[cut:].reshape(folds + 1, size)
