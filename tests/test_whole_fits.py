"""The model queries learn from all rows and fit the candidates whole."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lossloom.operators import leafwise as lw
from lossloom.operators import models
from lossloom.params import PdSettings
from lossloom.plans import default_model

SF = "/root/testdata/sf0.001"


def test_queries_learn_from_all_rows(spark, monkeypatch):
    """They learned from 750,000 rows of any number."""
    from workload import q_models
    from workload.common import labelled

    plain, seen = default_model.default_split, []

    def with_tight_cap(rows, s):
        seen.append(s.max_train_rows)
        return plain(rows, replace(s, max_train_rows=s.max_train_rows and 100))

    monkeypatch.setattr(default_model, "default_split", with_tight_cap)
    train, test = q_models.train_test(spark, SF)
    early = F.col("reporting_period") < F.lit("2000-01-01").cast("date")
    want = labelled(spark, SF).groupBy(early.alias("early"), "target").count().collect()
    assert seen == [None]
    for rows, side in ((train, True), (test, False)):
        assert {r["target"]: r["count"] for r in rows.groupBy("target").count().collect()} == {
            r["target"]: r["count"] for r in want if r["early"] is side}


def test_a_split_without_cap_keeps_every_row(spark):
    rows = spark.sql("""select id as loan_id, date_add(date'2021-01-01', cast(id % 700 as int)) as reporting_period,
        cast(id % 40 = 0 as int) as target, if(id % 9 = 0, null, id / 7e0) as x from range(3000)
        union all select 1, date'2021-01-02', 0, 1 / 7e0
        union all select null, null, 1, 0e0""")  # a row twice, one without a month
    train, test = default_model.default_split(rows, PdSettings(max_train_rows=None))
    n = rows.filter("reporting_period < '2022-01-01'").count()
    assert train.count() == n and train.exceptAll(train.distinct()).count() == 1
    assert test.count() == 3001 - n and train.columns == [*rows.columns, "split"]
    capped, _ = default_model.default_split(rows, PdSettings(max_train_rows=1200))
    assert capped.count() == 1200


@pytest.mark.parametrize("name", ["m9_boosted_trees", "m13_model_contest"])
def test_candidates_are_fitted_whole(spark, monkeypatch, name):
    """Eight trees stood for 300 and 400."""
    from workload.catalog import QUERIES

    plain, seen = models.fit_candidate, []

    def short(train, features, target, s):
        seen.append(s)
        return plain(train, features, target, replace(s, trees=2))

    monkeypatch.setattr(models, "fit_candidate", short)
    rows = QUERIES[name](spark, SF).collect()
    assert seen == list(models.CANDIDATES.values()) and {s.trees for s in seen} == {300, 400}
    assert {r["model"] for r in rows} >= set(models.CANDIDATES)


def test_one_task_grows_the_trees_of_the_passes(spark, monkeypatch):
    rows = spark.sql("""select id, pmod(hash(id), 97) / 9e0 as a, if(id % 11 = 0, null, pmod(hash(id, 1), 31) * 1e0) as b,
        cast(pmod(hash(id), 97) + pmod(hash(id, 1), 31) + pmod(hash(id, 2), 60) > 110 as int) as y from range(4000)""")
    s = lw.LeafSettings(trees=5, leaves=12)
    monkeypatch.setattr(lw, "ALONE_TREES", 2)
    alone = lw.fit_leafwise(rows, ["a", "b"], F.col("id"), "y", s)
    monkeypatch.setattr(lw, "ALONE_ROWS", 0)
    passes = lw.fit_leafwise(rows, ["a", "b"], F.col("id"), "y", s)
    a, b = (m.score(rows).orderBy("id").toPandas()["pd"] for m in (alone, passes))
    assert len(alone.trees) == 5 and abs(a - b).max() < 1e-9
    assert [t.feature for t in alone.trees] == [t.feature for t in passes.trees]
