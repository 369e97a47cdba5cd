"""Sketches per quarter against exact counts and ranks."""

import numpy as np
import pytest

from lossloom.operators import sketches as sk
from lossloom.sources.versions import VersionedWarehouse

QUARTERS = ["2018Q1", "2018Q2", "2018Q3", "2018Q4"]


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(8)
    data = [(int(r.integers(0, 15_000)), QUARTERS[int(r.integers(0, 4))], float(r.gamma(2.0)),
             None if i % 9 == 0 else float(round(r.normal(700, 40)))) for i in range(60_000)]
    return data, spark.createDataFrame(data, "loan_id long, vintage string, x double, fico double")


def near_rank(values, value, p):
    """Is p within the error of the ranks that the value stands for?"""
    a = np.sort(values)
    low, high = np.searchsorted(a, value, "left") / len(a), np.searchsorted(a, value, "right") / len(a)
    return low - sk.RANK_ERROR <= p <= high + sk.RANK_ERROR


def test_any_range_of_quarters(spark, rows, tmp_path):
    data, df = rows
    store = VersionedWarehouse(spark, str(tmp_path))
    sk.add_quarters(store, df, ["x", "fico"])
    for first, last in ((None, None), ("2018Q2", "2018Q3"), ("2018Q4", None)):
        own = [d for d in data if (first or "") <= d[1] <= (last or "9")]
        c = sk.counts(store, first, last).first()
        assert c.n_rows == len(own) and c.quarters == len({d[1] for d in own})
        loans = len({d[0] for d in own})
        assert abs(c.n_loans / loans - 1) < 4 * sk.LOAN_ERROR
        for k, f in ((2, "x"), (3, "fico")):
            known = [d[k] for d in own if d[k] is not None]
            for q in sk.quantiles(store, f, [.01, .25, .5, .9, .99], first, last).collect():
                assert q.n == len(known) and near_rank(known, q.value, q.probability)
    assert sk.counts(store, "2030Q1").first().n_loans == 0
    assert sk.quantiles(store, "x", [.5], "2030Q1").count() == 0


def test_a_new_quarter_touches_no_other(spark, rows, tmp_path):
    _, df = rows
    store = VersionedWarehouse(spark, str(tmp_path))
    sk.add_quarters(store, df.filter("vintage < '2018Q4'"), ["x"])
    before = store.manifest().parts[sk.TABLE]
    assert sk.add_quarters(store, df.filter("vintage = '2018Q4'"), ["x"]) == ["vintage=2018Q4"]
    after = store.manifest().parts[sk.TABLE]
    assert {p: after[p] for p in before} == before and len(after) == 4
    whole = VersionedWarehouse(spark, str(tmp_path / "whole"))
    sk.add_quarters(whole, df, ["x"])
    assert sk.counts(store).first() == sk.counts(whole).first()
