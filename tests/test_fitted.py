import pytest
from pyspark.sql import functions as F

from lossloom.operators import binning, models, regression
from lossloom.operators.leafwise import LeafSettings
from lossloom.operators.models import TreeSettings
from lossloom.sources.fitted import load_fitted, save_fitted


@pytest.fixture(scope="module")
def rows(spark):
    """Late loans default more often; scores of every tenth row are unknown."""
    data = []
    for i in range(900):
        late, score = i % 5, None if i % 10 == 3 else float(600 + (i * 37) % 200)
        data.append((i, float(late), score, int((i * 7919) % 100 < 4 + 9 * late)))
    return spark.createDataFrame(data, "k long, late double, score double, target int").cache()


def test_models_score_the_same_after_loading(spark, rows, tmp_path):
    card = models.fit_scorecard(rows, ["late", "score"])
    trees = models.fit_trees(rows, ["late", "score"], s=TreeSettings(trees=3, depth=2))
    leafwise = models.fit_candidate(rows, ["late", "score"], "target", LeafSettings(trees=2, leaves=4))
    for name, fitted in (("card", card), ("trees", trees), ("leafwise", leafwise)):
        path = str(tmp_path / name)
        save_fitted(spark, fitted, path)
        save_fitted(spark, fitted, path)    # a second save replaces the first
        again = load_fitted(spark, path)
        assert type(again) is type(fitted)
        both = again.score(fitted.score(rows, "p"), "q")
        assert both.filter("p is null or p <> q").count() == 0
    scored = card.score(rows)
    cal = models.fit_calibrator(scored, "pd", "target")
    save_fitted(spark, cal, str(tmp_path / "cal"))
    both = load_fitted(spark, str(tmp_path / "cal")).apply(cal.apply(scored, "pd", "a"), "pd", "b")
    assert both.filter("a <> b").count() == 0
    woe = binning.fit_woe(rows, ["score"], "target")
    fit = regression.fit_linear(rows, ["late"], "target")
    for name, fitted in (("woe", woe), ("fit", fit)):
        save_fitted(spark, fitted, str(tmp_path / name))
        assert load_fitted(spark, str(tmp_path / name)) == fitted


def test_points_follow_the_scaling_record(rows):
    card = models.fit_scorecard(rows, ["late", "score"])
    record = card.scaling_record(pdo=15, base_score=500, base_odds=10)
    assert set(record["coefficients"]) == {"late", "score"} and record["factor"] > 0
    odds = (1 - F.col("pd")) / F.col("pd")
    out = card.score(rows).select((card.points(record) - 500 - 15 * F.log2(odds / 10)).alias("gap"))
    assert out.filter(F.abs("gap") > 1e-9).count() == 0


def test_folds_share_every_class_evenly(spark, rows):
    rare = rows.withColumn("target", (F.col("k") % 90 == 0).cast("int"))    # ten positives
    dealt = models.stratified_folds(rare, F.col("k").cast("string"), folds=4).cache()
    assert dealt.count() == 900 and dealt.columns == [*rare.columns, "fold"]
    for r in dealt.groupBy("target").pivot("fold").count().collect():
        counts = [r[str(f)] for f in range(4)]
        assert max(counts) - min(counts) <= 1
    again = models.stratified_folds(rare.repartition(7), F.col("k").cast("string"), folds=4)
    assert dealt.select("k", "fold").exceptAll(again.select("k", "fold")).count() == 0
    dealt = models.stratified_folds(rows, F.col("k").cast("string"))
    assert models.cross_validated_auc(dealt, ["late"]) > 0.6


def test_capped_features_are_numeric(spark):
    """Mostly zero, capped at 3, many values between: quantiles fall on the two spikes."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 100 < 97, 0.0).when(F.col("id") % 100 == 99, 3.0)
        .otherwise(1 + (F.col("id") % 3989) / 4000).alias("x"), (F.col("id") % 7 == 0).cast("int").alias("target"))
    table = binning.woe_table(rows, ["x"], "target").collect()
    assert {r["kind"] for r in table} == {"numeric"} and sum(r["n"] for r in table) == 40_000
    few = rows.withColumn("x", F.when(F.col("x") % 1 == 0, F.col("x")).otherwise(1.5))
    assert {r["value"] for r in binning.woe_table(few, ["x"], "target").collect()} == {0.0, 1.5, 3.0}
