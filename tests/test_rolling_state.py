"""State plus new months equals the whole history recomputed."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from lossloom.operators import features, rolling_state
from lossloom.params import FeatureSettings
from lossloom.sources.versions import VersionedWarehouse

KIND = ("loan_id string, reporting_period date, loan_age double, upb_current double, int_rate_current double, "
        "delq_status string, total_principal_current double, vintage string, fico_orig double, "
        "ltv_orig double, dti_orig double, upb_orig double, int_rate_orig double, state string")


@pytest.fixture(scope="module")
def panel(spark):
    """Loans with gaps, unknown statuses and balances, and one that begins late."""
    r = random.Random(11)
    rows = []
    for k in range(40):
        begin = r.randrange(3) if k else 25
        for m in range(begin, 30):
            if r.random() < .12:
                continue
            rows.append((f"L{k}", date(2018 + m // 12, 1 + m % 12, 1), float(m),
                         r.choice([0.0, None, 1e5 - 1e3 * m, 1e5 - 900.0 * m]), 4.0 + m / 50,
                         r.choice(["00", "00", "01", "02", "XX", None]), r.choice([None, 250.0, 300.5]),
                         "2018Q1", 700.0, 80.0, 30.0, r.choice([1e5, 0.0]) if k % 9 == 0 else 1e5, 4.0, "NY"))
    return spark.createDataFrame(rows, KIND).cache()


def rows_of(df, columns):
    out = []
    for r in df.select(*columns).collect():
        out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return sorted(out, key=str)


@pytest.mark.parametrize("s", [FeatureSettings(), FeatureSettings(2, 5, (3, 4, 9), 2)])
def test_months_added_one_by_one(spark, panel, tmp_path, s):
    whole = features.with_features(panel, s)
    columns = [c for c in whole.columns if c not in ("delq_status", "total_principal_current")]
    store = VersionedWarehouse(spark, str(tmp_path))
    cut = date(2019, 12, 1)
    rolling_state.save_state(store, rolling_state.initial_state(
        panel.filter(F.col("reporting_period") < F.lit(cut)), s), 4)
    for m in range(23, 30):
        month = panel.filter(F.col("reporting_period") == F.lit(date(2018 + m // 12, 1 + m % 12, 1)))
        assert rolling_state.add_month(store, month, "features", s, 4) == 0
    want = whole.filter(F.col("reporting_period") >= F.lit(cut))
    assert rows_of(store.read("features"), columns) == rows_of(want, columns)
    assert want.count() > 150 and want.filter("loan_id = 'L0'").count() > 0
    state = store.read(rolling_state.TABLE).drop("bucket")
    assert rows_of(state, rolling_state.STATE) == rows_of(
        rolling_state.initial_state(panel, s), rolling_state.STATE)


def test_late_rows_are_left_out_and_named(spark, panel):
    state = rolling_state.initial_state(panel)
    late = panel.filter(F.col("reporting_period") == F.lit(date(2019, 3, 1)))
    month = rolling_state.advance(state, late)
    assert month.features.count() == 0 and month.late.count() == late.count() > 0
    assert rows_of(month.state, rolling_state.STATE) == rows_of(state, rolling_state.STATE)


def test_a_month_reads_only_its_rows_and_the_state(spark, panel, tmp_path):
    path = str(tmp_path / "panel")
    panel.write.partitionBy("reporting_period").parquet(path)
    store = VersionedWarehouse(spark, str(tmp_path / "wh"))
    rows = spark.read.parquet(path)
    rolling_state.save_state(store, rolling_state.initial_state(
        rows.filter("reporting_period < '2020-06-01'").select(*panel.columns)), 2)
    new = spark.read.parquet(path).filter("reporting_period = '2020-06-01'").select(*panel.columns)
    seen = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reporting_period" in seen
    assert rolling_state.add_month(store, new, "features", buckets=2) == 0
    assert store.read("features").count() == new.count() > 0
