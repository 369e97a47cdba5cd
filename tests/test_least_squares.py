"""Linear fits by QR in a tree, logistic fits of all folds in one scan."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossloom.operators import least_squares as ls
from lossloom.operators import models, regression


def frame(spark, x, y, parts=4):
    names = [f"x{i}" for i in range(x.shape[1])]
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)]
    return names, spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names, "y"])).repartition(parts)


def least_norm(x, y):
    """What a centred SVD solver gives."""
    b = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=1e-10)[0]
    return b, y.mean() - x.mean(0) @ b


@pytest.mark.parametrize("parts", [1, 7, 90])
def test_regular_case(spark, parts):
    r = np.random.default_rng(3)
    x = r.normal(5, 2, (900, 4))
    y = x @ [1, -2, .5, 0] + 3 + r.normal(0, .1, 900)
    names, df = frame(spark, x, y, parts)
    fit = regression.fit_linear(df, names, "y")
    b, b0 = least_norm(x, y)
    assert np.allclose(fit.coefficients, b, atol=1e-10) and abs(fit.intercept - b0) < 1e-9
    miss = y - x @ b - b0
    assert fit.n == 900 and abs(fit.r2 - (1 - miss @ miss / ((y - y.mean()) @ (y - y.mean())))) < 1e-10


def test_collinear_features_get_the_solution_of_least_norm(spark):
    r = np.random.default_rng(4)
    x = r.normal(0, 1, (400, 3))
    x = np.column_stack((x, x[:, 0] + x[:, 1], np.full(400, 7.0), 2 * x[:, 2]))
    y = x @ [1, 2, 3, 1, 0, 1] + 2
    names, df = frame(spark, x, y)
    fit = regression.fit_linear(df, names, "y")
    b, b0 = least_norm(x, y)
    assert np.allclose(fit.coefficients, b, atol=1e-8) and abs(fit.intercept - b0) < 1e-8
    assert abs(fit.r2 - 1) < 1e-10


def test_badly_scaled_features(spark):
    """Columns of sizes 1e-6 to 1e6, one nearly a copy: normal equations lose these digits."""
    r = np.random.default_rng(5)
    z = r.normal(0, 1, (500, 4))
    z[:, 3] = z[:, 0] + 1e-5 * z[:, 3]
    x = z * [1e-6, 1, 1e6, 1] + [0, 1e3, 0, 0]
    want = np.array([2e6, -1, 3e-6, 4])
    names, df = frame(spark, x, x @ want + 5)
    fit = regression.fit_linear(df, names, "y")
    assert np.allclose(np.array(fit.coefficients) / want, 1, atol=1e-4) and abs(fit.r2 - 1) < 1e-12


def test_unknown_values_and_few_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 1.0), (4.0, None),
                                (float("nan"), 1.0)], "x double, y double")
    fit = regression.fit_linear(df, ["x"], "y")
    assert fit.n == 3 and abs(fit.coefficients[0] - 2) < 1e-12
    with pytest.raises(ValueError):
        regression.fit_linear(df.limit(0), ["x"], "y")


@pytest.fixture(scope="module")
def labelled(spark):
    r = np.random.default_rng(6)
    x = r.normal([3, -10, 100], [1, 5, 30], (1500, 3))
    p = 1 / (1 + np.exp(-((x - [3, -10, 100]) / [1, 5, 30] @ [1, -.5, .2] - 1)))
    y = (r.random(1500) < p).astype(float)
    rows = [(i, *map(float, a), float(b), i % 3) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return x, y, spark.createDataFrame(rows, "k long, a double, b double, c double, y double, fold int")


def single(x, y, penalty, means, scales):
    """Newton's method on the same rows alone."""
    z = np.column_stack((np.ones(len(x)), (x - means) / scales))
    b, ridge = np.zeros(z.shape[1]), np.diag([0, *[penalty] * x.shape[1]])
    for _ in range(50):
        q = 1 / (1 + np.exp(-z @ b))
        b = b + np.linalg.solve((z * (q * (1 - q))[:, None]).T @ z + ridge, z.T @ (y - q) - ridge @ b)
    return b


def test_fits_of_all_folds_equal_single_fits_in_the_scans_of_one(spark, labelled, monkeypatch):
    x, y, df = labelled
    scans = []
    plain = ls._moments
    monkeypatch.setattr(ls, "_moments", lambda *a: scans.append(1) or plain(*a))
    fits = ls.fit_folds(df, ["a", "b", "c"], "y", "fold", 3)
    fold = np.arange(1500) % 3
    for k in range(4):
        used = fold != k
        want = single(x[used], y[used], 1.0, fits.means, fits.scales)
        assert np.allclose(fits.coefficients[k], want, atol=1e-8)
    assert len(scans) == fits.rounds < 12
    scored = fits.scores(df, "fold").select("k", "fold", "score").collect()
    for r in scored[:50]:
        z = fits.coefficients[r.fold] @ [1, *((x[r.k] - fits.means) / fits.scales)]
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-12


def test_cross_validated_auc_is_that_of_the_held_out_rows(spark, labelled):
    _, y, df = labelled
    got = models.cross_validated_auc(df, ["a", "b", "c"], "y")
    scored = ls.fit_folds(df, ["a", "b", "c"], "y", "fold", 3).scores(df, "fold").orderBy("k").collect()
    aucs = []
    for k in range(3):
        own = [(r.score, r.y) for r in scored if r.fold == k]
        pos, neg = ([s for s, v in own if v == t] for t in (1, 0))
        aucs.append(np.mean([(a > b) + .5 * (a == b) for a in pos for b in neg]))
    assert abs(got - np.mean(aucs)) < 1e-12 and got > .7
    assert df.filter(F.col("y") == 1).count() == y.sum()
