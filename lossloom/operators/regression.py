"""Ordinary least squares and median imputation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossloom.functions.bounds import clip
from lossloom.operators import least_squares, ranks
from lossloom.operators.quality import long_values


@dataclass(frozen=True)
class LinearFit:
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    r2: float
    n: int

    def column(self, **replace: Column) -> Column:
        """Prediction as an expression; ``replace`` swaps a feature for another expression."""
        out = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coefficients):
            out = out + F.lit(weight) * replace.get(name, F.col(name))
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(f, c) for f, c in zip(self.features, self.coefficients)]
        rows.append(("intercept", self.intercept))
        return spark.createDataFrame(rows, "term string, coefficient double").withColumns(
            {"r2": F.lit(self.r2), "n_obs": F.lit(self.n)})


def fit_linear(df: DataFrame, features: list[str], target: str,
               min_rows: int | None = None) -> LinearFit:
    """Least squares with intercept on the rows where everything is known.

    One pass of QR over blocks of rows; collinear features get the solution of least norm.
    """
    clean = df.select(*features, F.col(target).cast("double").alias("_y"))
    clean = clean.na.drop()  # drops NaN as well
    minimum = len(features) + 2 if min_rows is None else min_rows
    r, n = least_squares.triangle(clean, [*features, "_y"])
    if n < minimum:
        raise ValueError(f"{n} usable rows, at least {minimum} are needed to fit {features}")
    coefficients, intercept, r2 = least_squares.least_norm(r, n)
    return LinearFit(tuple(features), tuple(map(float, coefficients)), intercept, r2, n)


def simple_regression(df: DataFrame, x: str, y: str) -> DataFrame:
    """One-feature least squares as plain aggregates: ``slope, intercept, r2, n_obs``."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return both.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                    F.regr_r2(y, x).alias("r2"), F.count(F.lit(1)).alias("n_obs"))


def clipped(prediction: Column, floor: float) -> Column:
    return clip(prediction, floor, 1.0)


def medians(df: DataFrame, features: list[str]) -> DataFrame:
    """Exact median per feature; a feature without values has no row."""
    found = ranks.exact_quantiles(long_values(df, features), ["feature"], "x", [0.5])
    return found.select("feature", F.get("quantiles", F.lit(0)).alias("median"))


def impute_medians(df: DataFrame, features: list[str]) -> tuple[DataFrame, list[str]]:
    """Fill missing values with the median; features without any value are left out."""
    known = {r["feature"]: r["median"] for r in medians(df, features).collect()}  # one per feature
    kept = [f for f in features if f in known]
    if not kept:
        raise ValueError(f"no usable feature among {features}")
    filled = {f: F.coalesce(F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")),
                            F.lit(known[f])) for f in kept}
    return df.withColumns(filled), kept
