"""Default and prepayment models with MLlib, calibration, and scorers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from math import log

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lossloom.functions.bounds import no_nan
from lossloom.functions.hashing import hash32
from lossloom.operators import least_squares
from lossloom.operators.binning import WoeMap, fit_woe
from lossloom.operators.durable import small_side
from lossloom.operators.isotonic import Calibrator, fit_calibrator  # noqa: F401
from lossloom.operators.leafwise import LeafSettings, LeafTrees, fit_leafwise
from lossloom.operators.metrics import best_by_auc, class_weight, ranking_metrics, score_counts
from lossloom.operators.regression import medians


def with_balance_weight(df: DataFrame, target: str) -> DataFrame:
    """Row weight that gives both classes half of the total weight."""
    c = class_weight(df, target)
    n = F.col("pos") + F.col("neg")
    weights = c.select(F.array(F.try_divide(n, 2 * F.col("neg")),
                               F.try_divide(n, 2 * F.col("pos"))).alias("w")).scalar()
    return df.withColumn("_weight", F.get(weights, F.col(target).cast("int")))


def with_positive_weight(df: DataFrame, target: str) -> DataFrame:
    """Row weight of 1 for negatives and negatives-per-positive for positives."""
    weight = class_weight(df, target).select("pos_weight").scalar()
    return df.withColumn("_weight", F.when(F.col(target) == 1, weight).otherwise(F.lit(1.0)))


@dataclass
class Scorecard:
    """Class-balanced logistic regression on weight-of-evidence columns."""

    woe: WoeMap
    model: PipelineModel
    features: list[str]

    @property
    def coefficients(self) -> dict[str, float]:
        return dict(zip(self.features, (float(c) for c in self.model.stages[-1].coefficients)))

    @property
    def intercept(self) -> float:
        return float(self.model.stages[-1].intercept)

    def log_odds(self) -> Column:
        """Log-odds of being bad as an expression over the raw features."""
        out = F.lit(self.intercept)
        for name, weight in self.coefficients.items():
            out = out + F.lit(weight) * self.woe.column(name)
        return out

    def scaling_record(self, pdo: float = 20, base_score: float = 600,
                       base_odds: float = 50.0) -> dict:
        """What turns this card into points: factor, offset, coefficients and intercept."""
        factor = pdo / log(2)
        return {"pdo": pdo, "base_score": base_score, "base_odds": base_odds, "factor": factor,
                "offset": base_score - factor * log(base_odds),
                "coefficients": self.coefficients, "intercept": self.intercept}

    def points(self, record: dict) -> Column:
        """Points of a row by a scaling record of this card."""
        return F.lit(record["offset"]) - F.lit(record["factor"]) * self.log_odds()

    def score(self, df: DataFrame, out: str = "pd", log_odds: str | None = None,
              points: dict | None = None) -> DataFrame:
        """Add the probability ``out``, and as columns :meth:`log_odds` by that name and ``points`` by a
        record of this card: they share the bins found for the score."""
        binned = self.woe.transform(df)
        odds = F.lit(self.intercept)
        for name, weight in self.coefficients.items():
            odds = odds + F.lit(weight) * F.col(f"{name}_woe")
        new = {} if log_odds is None else {log_odds: odds}
        if points is not None:
            new["points"] = F.lit(points["offset"]) - F.lit(points["factor"]) * odds
        scored = self.model.transform(binned.withColumns(new) if new else binned)
        return (scored.withColumn(out, vector_to_array("probability")[1])
                .drop(*[f"{f}_woe" for f in self.features], "_x", "rawPrediction",
                      "probability", "prediction"))


def fit_scorecard(train: DataFrame, features: list[str], target: str = "target",
                  bins: int = 8) -> Scorecard:
    """L2 penalty of strength 1 against the sum of the weighted losses, intercept free."""
    woe = fit_woe(train, features, target, bins)
    used = [f for f in features if f in woe.bins]
    weighted = with_balance_weight(woe.transform(train), target)
    rows = train.count()
    columns = [f"{f}_woe" for f in used]
    model = Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="_x"),
        LogisticRegression(featuresCol="_x", labelCol=target, weightCol="_weight", maxIter=1000,
                           regParam=1.0 / max(rows, 1), elasticNetParam=0.0,
                           standardization=False),
    ]).fit(weighted.select(*columns, F.col(target).cast("double").alias(target), "_weight"))
    return Scorecard(woe, model, used)


@dataclass
class BoostedTrees:
    """Gradient-boosted trees; missing values become the median plus an indicator."""

    model: PipelineModel
    fill: dict[str, float]
    features: list[str]

    def prepare(self, df: DataFrame) -> DataFrame:
        return _tree_inputs(df, self.features, self.fill)

    def score(self, df: DataFrame, out: str = "pd") -> DataFrame:
        scored = self.model.transform(self.prepare(df))
        helpers = [f"{p}{f}" for f in self.features for p in ("_v_", "_m_")]
        return (scored.withColumn(out, vector_to_array("probability")[1])
                .drop(*helpers, "_x", "rawPrediction", "probability", "prediction"))


def _tree_inputs(df: DataFrame, features: list[str], fill: dict[str, float]) -> DataFrame:
    new = {}
    for f in features:
        x = no_nan(F.col(f).cast("double"))
        new[f"_v_{f}"] = F.coalesce(x, F.lit(float(fill.get(f, 0.0))))
        new[f"_m_{f}"] = x.isNull().cast("double")
    return df.withColumns(new)


@dataclass(frozen=True)
class TreeSettings:
    trees: int = 300
    depth: int = 5
    step: float = 0.05
    row_share: float = 0.8
    column_share: str = "0.8"
    seed: int = 42


# Sizes of the two boosted candidates, level-wise of depth 5 and leaf-wise of 31 leaves.
CANDIDATES: dict[str, TreeSettings | LeafSettings] = {
    "levelwise_300": TreeSettings(trees=300, depth=5), "leafwise_400": LeafSettings(trees=400)}


def fit_candidate(train: DataFrame, features: list[str], target: str,
                  s: TreeSettings | LeafSettings) -> BoostedTrees | LeafTrees:
    """The boosted model of these settings. Leaf-wise samples tell rows apart by their features."""
    if isinstance(s, LeafSettings):
        return fit_leafwise(train, features, F.xxhash64(*features), target, s)
    return fit_trees(train, features, target, s)


def fit_trees(train: DataFrame, features: list[str], target: str = "target",
              s: TreeSettings = TreeSettings()) -> BoostedTrees:
    fill = {r["feature"]: r["median"] for r in medians(train, features).collect()}
    weighted = with_positive_weight(_tree_inputs(train, features, fill), target)
    inputs = [f"{p}{f}" for f in features for p in ("_v_", "_m_")]
    model = Pipeline(stages=[
        VectorAssembler(inputCols=inputs, outputCol="_x"),
        GBTClassifier(featuresCol="_x", labelCol=target, weightCol="_weight", maxIter=s.trees,
                      maxDepth=s.depth, stepSize=s.step, subsamplingRate=s.row_share,
                      featureSubsetStrategy=s.column_share, seed=s.seed),
    ]).fit(weighted.select(*inputs, F.col(target).cast("double").alias(target), "_weight"))
    return BoostedTrees(model, fill, list(features))


RANGES = 65_536


def stratified_folds(df: DataFrame, key: Column, target: str = "target", folds: int = 3,
                     seed: int = 42) -> DataFrame:
    """Add ``fold``: every class is dealt evenly, so class counts of folds differ by one at most.

    Rows are numbered per class in hash order without a global sort: counts of 65,536 hash ranges
    give each range its first number, and only rows of one class and range are ranked together.
    """
    hashed = df.withColumn("_h", hash32(key, seed)).withColumn("_tie", F.md5(key)).withColumn(
        "_range", F.floor(F.col("_h") / (1 << 16)).cast("int"))
    counts = hashed.groupBy(target, "_range").agg(F.count(F.lit(1)).alias("_n"))
    order = W.partitionBy(target).orderBy("_range")  # at most RANGES rows per class
    starts = counts.select(target, "_range", (F.sum("_n").over(order) - F.col("_n")).alias("_first"))
    own = F.row_number().over(W.partitionBy(target, "_range").orderBy("_h", "_tie")) - 1
    fold = ((F.col("_first") + own) % folds).cast("int").alias("fold")
    return hashed.join(small_side(starts, 2 * RANGES), [target, "_range"]).select(
        *df.columns, fold)


def cross_validated_auc(df: DataFrame, features: list[str], target: str = "target",
                        estimator=None, folds: int = 3, fold: str = "fold") -> float:
    """Mean exact area under the ROC curve over the held-out parts of column ``fold``.

    Without an ``estimator`` penalised logistic fits of all folds share their scans; with one, MLlib
    fits it fold by fold.
    """
    if estimator is None:
        fits = least_squares.fit_folds(df, features, target, fold, folds)
        sliced = score_counts(fits.scores(df, fold, "_score"), target, "_score", [fold])
        return float(ranking_metrics(sliced, [fold]).agg(F.avg("auc")).first()[0])
    data = VectorAssembler(inputCols=features, outputCol="features").transform(df)
    data = data.select("features", F.col(target).cast("double").alias("label"), fold)
    runner = CrossValidator(
        estimator=estimator, numFolds=folds, foldCol=fold,
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0))
    return float(runner.fit(data).avgMetrics[0])


def calibration_summary(scored: DataFrame, score: str, calibrated: str,
                        target: str) -> DataFrame:
    return scored.agg(F.avg(target).alias("observed_default_rate"),
                      F.avg(score).alias("mean_raw_score"),
                      F.avg(calibrated).alias("mean_calibrated_pd"))


def scorecard_points(odds_log: Column, pdo: float = 20, base_score: float = 600,
                     base_odds: float = 50.0) -> Column:
    """Points for a log-odds of being good: ``pdo`` points double the odds."""
    factor = pdo / log(2)
    return F.lit(base_score - factor * log(base_odds)) + F.lit(factor) * odds_log


Scorer = Callable[[DataFrame], DataFrame]
"""Adds a ``pd`` column to a frame that has the model features."""


def model_scorer(model, calibrator: Calibrator | None = None) -> Scorer:
    def score(df: DataFrame) -> DataFrame:
        scored = model.score(df, "_raw_pd")
        if calibrator is None:
            return scored.withColumnRenamed("_raw_pd", "pd")
        return calibrator.apply(scored, "_raw_pd", "pd").drop("_raw_pd")
    return score


def column_scorer(expr: Column) -> Scorer:
    return lambda df: df.withColumn("pd", expr)


@dataclass
class Contest:
    """Fitted candidates, their out-of-time metrics and the winner's name."""

    models: dict
    metrics: DataFrame
    best: str
    curves: dict[str, DataFrame] = field(default_factory=dict)


def train_and_compare(train: DataFrame, test: DataFrame, features: list[str],
                      target: str = "target", bins: int = 8,
                      trees: dict[str, TreeSettings | LeafSettings] | None = None) -> Contest:
    """Fit the scorecard and the boosted candidates and rank them on the test rows."""
    models: dict = {"scorecard": fit_scorecard(train, features, target, bins)}
    for name, s in (CANDIDATES if trees is None else trees).items():
        models[name] = fit_candidate(train, features, target, s)
    scored = test
    for name, model in models.items():
        scored = model.score(scored, f"_p_{name}")
    long = scored.select(F.col(target), F.explode(F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(f"_p_{n}").alias("p")) for n in models
    ])).alias("s")).select(target, "s.model", "s.p")
    sliced = score_counts(long, target, "p", ["model"])
    metrics = ranking_metrics(sliced, ["model"])
    best = best_by_auc(metrics).first()["model"]
    return Contest(models, metrics, best,
                   {"scores": sliced.filter(F.col("model") == best)})
