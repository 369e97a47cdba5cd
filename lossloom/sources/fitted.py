"""Fitted models on shared storage: fit once, load in later stages.

A model is a folder with its MLlib part or its pools (if it has any) and one line of JSON with
everything else: bins, fill values, feature names, coefficients.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from lossloom.operators.binning import WoeMap
from lossloom.operators.leafwise import LeafTrees
from lossloom.operators.models import BoostedTrees, Calibrator, Scorecard
from lossloom.operators.regression import LinearFit

Fitted = Scorecard | BoostedTrees | LeafTrees | Calibrator | WoeMap | LinearFit


def save_fitted(spark: SparkSession, fitted: Fitted, path: str) -> None:
    """Write a fitted model to ``path``; an earlier one there is replaced."""
    kind = type(fitted).__name__
    if isinstance(fitted, Scorecard):
        extra = {"bins": fitted.woe.bins, "features": fitted.features}
    elif isinstance(fitted, BoostedTrees):
        extra = {"fill": fitted.fill, "features": fitted.features}
    elif isinstance(fitted, LeafTrees):
        extra = {"model": fitted.to_json()}
    elif isinstance(fitted, WoeMap):
        extra = {"bins": fitted.bins}
    elif isinstance(fitted, LinearFit):
        extra = asdict(fitted)
    else:
        extra = {}
    if isinstance(fitted, Calibrator):
        fitted.pools.write.mode("overwrite").parquet(f"{path}/pools")
    if isinstance(fitted, Scorecard | BoostedTrees):
        fitted.model.write().overwrite().save(f"{path}/mllib")
    line = json.dumps({"kind": kind, **extra})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/rest")


def load_fitted(spark: SparkSession, path: str) -> Fitted:
    """The model that :func:`save_fitted` wrote to ``path``; it scores the same."""
    rest = json.loads(spark.read.text(f"{path}/rest").first()["value"])
    kind = rest.pop("kind")
    if kind == "Scorecard":
        return Scorecard(WoeMap(rest["bins"]), PipelineModel.load(f"{path}/mllib"), rest["features"])
    if kind == "BoostedTrees":
        return BoostedTrees(PipelineModel.load(f"{path}/mllib"), rest["fill"], rest["features"])
    if kind == "LeafTrees":
        return LeafTrees.from_json(rest["model"])
    if kind == "Calibrator":
        return Calibrator(spark.read.parquet(f"{path}/pools"))
    if kind == "WoeMap":
        return WoeMap(rest["bins"])
    return LinearFit(tuple(rest["features"]), tuple(rest["coefficients"]), rest["intercept"],
                     rest["r2"], rest["n"])
