import numpy as np
import pytest
from pyspark.sql import functions as F

from lossloom.operators.durable import small_side
from lossloom.operators import binning, metrics, models, ranks, sampling

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("shape", ["normal", "few", "hot", "tiny"])
def test_quantiles_match_a_full_sort(spark, shape):
    rng = np.random.default_rng(1)
    values = {"normal": rng.normal(size=6000), "few": rng.integers(0, 7, 6000).astype(float),
              # a third of the rows share one value
              "hot": np.where(rng.random(6000) < 0.34, 5.0, rng.exponential(9, 6000)),
              "tiny": np.array([3.0, 1.0, 2.0])}[shape]
    frame = spark.createDataFrame([("g", float(v)) for v in values] + [("h", 1.0)],
                                  "g string, x double")
    got = {r["g"]: r for r in ranks.exact_quantiles(frame, ["g"], "x", PROBS).collect()}
    assert np.allclose(got["g"]["quantiles"], np.quantile(values, PROBS), rtol=1e-12)
    assert got["g"]["n_total"] == len(values) and got["h"]["quantiles"] == [1.0] * 6


def test_compaction_merges_most_values_and_keeps_totals(spark):
    rng = np.random.default_rng(2)
    frame = spark.createDataFrame([(float(v),) for v in rng.normal(size=20000)], "x double")
    counts = ranks.compact_counts(frame, [], "x", [0.5]).cache()
    assert counts.agg(F.sum("n")).first()[0] == 20000
    assert counts.count() < 400


def test_inexact_rank_falls_back_to_all_values(spark, monkeypatch):
    rng = np.random.default_rng(3)
    values = rng.normal(size=5000)
    frame = spark.createDataFrame([(float(v),) for v in values], "x double")
    original = ranks.compact_counts
    monkeypatch.setattr(ranks, "compact_counts",
                        lambda df, by, v, p, *a, **k: original(df, by, v, [0.01], *a, **k))
    got = ranks.exact_quantiles(frame, [], "x", [0.7]).first()["quantiles"][0]
    assert abs(got - np.quantile(values, 0.7)) < 1e-12


def scores(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")


def test_perfect_separation(spark):
    frame = scores(spark, [0, 0, 0, 1, 1, 1], [0.1, 0.2, 0.3, 0.7, 0.8, 0.9])
    m = metrics.ranking_metrics(metrics.score_counts(frame, "y", "p")).first()
    assert (m["auc"], m["gini"], m["ks"], m["precision"], m["recall"]) == (1, 1, 1, 1, 1)


def test_auc_counts_ties_half_and_brier_is_mean_square(spark):
    rng = np.random.default_rng(4)
    y, p = rng.integers(0, 2, 800), rng.integers(0, 20, 800) / 20
    m = metrics.ranking_metrics(metrics.score_counts(scores(spark, y, p), "y", "p")).first()
    diff = p[y == 1][:, None] - p[y == 0][None, :]
    assert abs(m["auc"] - ((diff > 0).mean() + (diff == 0).mean() / 2)) < 1e-12
    assert abs(m["brier"] - np.mean((p - y) ** 2)) < 1e-12


def test_roc_starts_at_origin_and_drops_collinear_points(spark):
    y = [1, 1, 1, 0, 0, 0]
    p = [0.9, 0.8, 0.7, 0.3, 0.2, 0.1]
    got = metrics.roc_points(metrics.score_counts(scores(spark, y, p), "y", "p"))
    points = [(r["fpr"], r["tpr"]) for r in got.orderBy("position").collect()]
    # first and last stay, the corner stays, steps that repeat on a straight line go
    assert points == [(0, 0), (0, 1 / 3), (0, 1), (1, 1)]


def test_curves_are_thinned_evenly(spark):
    rng = np.random.default_rng(5)
    p = rng.permutation(1000) / 1000
    y = (rng.random(1000) < p).astype(int)
    sliced = metrics.score_counts(scores(spark, y, p), "y", "p")
    got = [r[0] for r in metrics.ks_points(sliced).orderBy("pop_pct").select("pop_pct").collect()]
    want = (np.unique(np.linspace(0, 999, 60).round()) + 1) / 1000
    assert np.allclose(got, want)


def test_calibration_table_bins(spark):
    rng = np.random.default_rng(6)
    p = rng.random(2000)
    y = (rng.random(2000) < p).astype(int)
    got = metrics.calibration_table(metrics.score_counts(scores(spark, y, p), "y", "p"))
    rows = got.orderBy("bin").collect()
    edges = np.unique(np.quantile(p, np.linspace(0, 1, 11)))
    idx = np.digitize(p, edges[1:-1])
    assert [r["n"] for r in rows] == [int((idx == b).sum()) for b in range(10)]
    assert np.allclose([r["pred_pd"] for r in rows], [p[idx == b].mean() for b in range(10)])


def woe_by_hand(x, y, bins):
    edges = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)))
    idx = np.digitize(x, edges[1:-1])
    bad, good = max((y == 1).sum(), 1), max((y == 0).sum(), 1)
    iv = 0.0
    for b in np.unique(idx):
        pb = ((y[idx == b] == 1).sum() + 0.5) / (bad + 0.5)
        pg = ((y[idx == b] == 0).sum() + 0.5) / (good + 0.5)
        iv += (pg - pb) * np.log(pg / pb)
    return iv


def test_woe_bins_and_transform(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, 3000)
    y = (rng.random(3000) < 0.1 + 0.3 * (x > 0)).astype(int)
    rows = [(float(a), float(i % 3), 1.0, int(b)) for i, (a, b) in enumerate(zip(x, y))]
    rows += [(None, None, 1.0, 1)]
    frame = spark.createDataFrame(rows, "f double, d double, c double, y int")
    table = binning.woe_table(frame, ["f", "d", "c"], "y", 5).cache()
    kinds = {(r["feature"], r["kind"]) for r in table.select("feature", "kind").collect()}
    assert kinds == {("f", "null"), ("f", "numeric"), ("d", "null"), ("d", "discrete"),
                     ("c", "discrete")}
    assert table.agg(F.sum("n")).first()[0] == 3 * 3001
    iv = {r["feature"]: r["iv"] for r in binning.information_values(table).collect()}
    assert abs(iv["f"] - woe_by_hand(x, y, 5)) < 0.01 and all(v >= 0 for v in iv.values())
    woe = binning.WoeMap.from_table(table)
    out = woe.transform(frame.unionByName(spark.createDataFrame(
        [(9e9, 77.0, 5.0, 0)], frame.schema)))
    assert out.filter("f_woe is null or d_woe is null or c_woe is null").count() == 0
    assert out.filter("d = 77").first()["d_woe"] == 0.0


def test_rare_class_sample_is_exact_and_repeatable(spark):
    frame = spark.range(20000).select("id", (F.col("id") % 100 == 0).cast("int").alias("target"))
    a = sampling.keep_rare_class(frame, 5000, sampling.row_key("id"), 42)
    b = sampling.keep_rare_class(frame.repartition(5), 5000, sampling.row_key("id"), 42)
    counts = {r["target"]: r["count"] for r in a.groupBy("target").count().collect()}
    assert counts == {1: 200, 0: 4800}
    assert a.select("id").exceptAll(b.select("id")).count() == 0
    assert sampling.keep_rare_class(frame, 50000, sampling.row_key("id"), 42).count() == 20000


def test_proportional_sample_keeps_the_rate(spark):
    frame = spark.range(20000).select("id", (F.col("id") % 5 == 0).cast("int").alias("target"))
    got = sampling.keep_class_rates(frame, 5000, sampling.row_key("id"), 1)
    counts = {r["target"]: r["count"] for r in got.groupBy("target").count().collect()}
    assert counts == {1: 1000, 0: 4000}


def test_isotonic_calibration_hits_the_base_rate(spark):
    rng = np.random.default_rng(0)
    y = (rng.random(8000) < 0.02).astype(int)
    p = np.clip(0.1 + 0.8 * y + rng.normal(0, 0.1, 8000), 0, 1)
    frame = scores(spark, y, p)
    out = models.fit_calibrator(frame, "p", "y").apply(frame, "p", "cal")
    got = models.calibration_summary(out, "p", "cal", "y").first()
    assert abs(got["mean_calibrated_pd"] - got["observed_default_rate"]) < 0.005


def test_scorecard_matches_the_penalised_optimum(spark):
    rng = np.random.default_rng(7)
    x = rng.integers(0, 4, 4000).astype(float)
    y = (rng.random(4000) < 0.05 + 0.1 * x).astype(int)
    frame = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "f double, target int")
    card = models.fit_scorecard(frame, ["f"])
    woe = {r["value"]: r["woe"] for r in card.woe.bins["f"]}
    v = np.array([woe[a] for a in x])
    w = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    b, b0 = card.coefficients["f"], card.intercept
    residual = w * (1 / (1 + np.exp(-(b0 + b * v))) - y)
    # gradient of |b|^2 / 2 + sum of weighted log losses
    assert abs(residual @ v + b) < 1.0 and abs(residual.sum()) < 1.0


def test_broadcasts_are_bound_by_rows_and_bytes(spark):
    wide = spark.range(10).select("id", F.array_repeat(F.lit(1.5), 1000).alias("edges"))
    hints = [str(small_side(wide, *bounds)._jdf.queryExecution().logical()) for bounds in (
        (10, 10**6), (9, 10**6), (10, 1000))]
    assert ["ResolvedHint" in h or "UnresolvedHint" in h for h in hints] == [True, False, False]
