"""Rates and sketches take one pass over the rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from lossloom.operators import binning, labels, ranks

SF = "/root/testdata/sf0.001"


def test_closed_rate_is_the_mean_before_the_open_window(spark):
    rows = spark.createDataFrame([(date(2018 + k // 12, k % 12 + 1, 1 + k % 20), int(k * 7 % 5 == 0)) for k in range(40)] * 3
                                 + [(None, 1), (date(2018, 1, 1), 1)], "reporting_period date, target int")
    want = labels.drop_open_window(rows, 12).agg(F.avg("target")).first()[0]
    assert labels.closed_rate(rows, 12).first()[0] == pytest.approx(want, rel=1e-15)
    assert labels.closed_rate(rows.limit(0), 12).collect() == [(None,)]


def test_long_run_rate_stores_no_loan_months(spark, monkeypatch):
    """The labelled months were stored with the columns of the scores, and read twice, for one number."""
    from workload import common, q_cohort

    stored, plain = [], type(spark.range(1)).checkpoint
    monkeypatch.setattr(type(spark.range(1)), "checkpoint",
                        lambda df, *a, **k: stored.append(df.columns) or plain(df, *a, **k))
    case = q_cohort.flat_case(spark, SF)
    assert stored == [["month", "n", "bad"]]
    ttc = common.closed(spark, SF).agg(F.avg("target")).first()[0]
    assert case.multipliers == q_cohort.flat_case(spark, SF, common.closed(spark, SF)).multipliers and ttc > 0


def test_bins_sketch_all_columns_in_one_row_of_aggregates(spark, monkeypatch):
    """Every value was a row of its own, grouped by the name of its column."""
    nan = float("nan")
    rows = spark.range(5000).select(
        (F.col("id") % 7).alias("few"), (F.col("id") * 37 % 4999 / 3.0).alias("many"),
        F.when(F.col("id") % 3 == 0, F.lit(nan)).when(F.col("id") % 3 == 1, -0.0).alias("odd"),
        F.lit(None).cast("double").alias("none"), (F.col("id") % 4 == 0).cast("int").alias("target"))
    names, probs, given = ["few", "many", "odd", "none"], [i / 8 for i in range(9)], []
    plain = ranks.ranked_counts
    monkeypatch.setattr(ranks, "ranked_counts", lambda *a, **k: given.append(k.get("sketch")) or plain(*a, **k))
    new = {tuple(r) for r in binning.woe_table(rows, names, "target").collect()}
    assert {r["feature"]: (r["_few"], r["_q"] is None) for r in given[0].collect()} == {
        "few": (True, False), "many": (False, False), "odd": (True, False), "none": (True, True)}
    monkeypatch.setattr(ranks, "ranked_counts", lambda *a, **k: plain(*a, **{**k, "sketch": None}))
    assert {tuple(r) for r in binning.woe_table(rows, names, "target").collect()} == new
