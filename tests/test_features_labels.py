from datetime import date

import pytest
from pyspark.sql import functions as F

from lossloom.operators import features, labels
from lossloom.params import FeatureSettings


def months(first: date, n: int) -> list[date]:
    start = first.year * 12 + first.month - 1
    return [date((start + i) // 12, (start + i) % 12 + 1, 1) for i in range(n)]


PANEL = ("loan_id string, reporting_period date, upb_current double, upb_orig double, "
         "ltv_orig double, int_rate_current double, int_rate_orig double, delq_status string, "
         "total_principal_current double")


def panel(spark, statuses, balances, paid):
    days = months(date(2018, 1, 1), len(statuses))
    rows = [("A", d, b, 200000.0, 80.0, 4.5, 4.0, s, p)
            for d, s, b, p in zip(days, statuses, balances, paid)]
    return spark.createDataFrame(rows, PANEL)


def column(df, name):
    return [r[0] for r in df.orderBy("reporting_period").select(name).collect()]


@pytest.fixture(scope="module")
def out(spark):
    rows = panel(spark, ["00", "00", "01", "02", "XX"],
                 [200000.0, 198000.0, 196000.0, 194000.0, 192000.0], [2000.0, None, 2000.0, 2000.0, 2000.0])
    return features.with_features(rows, FeatureSettings(2, 2, (3, 6), 1)).cache()


def test_levels(out):
    assert column(out, "months_on_book") == [0, 1, 2, 3, 4]
    assert column(out, "delq_num") == [0, 0, 1, 2, None]
    assert abs(column(out, "current_ltv")[-1] - 76.8) < 1e-9
    assert column(out, "rate_spread_vs_orig")[0] == 0.5


def test_windows(out):
    assert column(out, "max_delq_6m") == [0, 0, 1, 2, 2]
    assert column(out, "count_30dpd_6m") == [0, 0, 1, 2, 2]
    assert column(out, "ever_30dpd_6m") == [0, 0, 1, 1, 1]
    assert column(out, "cum_principal_paid") == [2000, None, 4000, 6000, 8000]
    assert column(out, "delq_change_2m") == [None, None, 1.0, 2.0, None]


def test_unreported_balance_is_missing(spark):
    rows = panel(spark, ["00"] * 4, [0.0, 0.0, 80000.0, 79500.0], [0.0] * 4)
    out = features.with_features(rows, FeatureSettings(2, 2, (3, 6), 1))
    assert column(out, "current_ltv")[:2] == [None, None]
    assert column(out, "upb_paydown_ratio")[:2] == [None, None]
    assert column(out, "current_ltv")[2] is not None
    assert column(out, "balance_change_2m") == [None] * 4
    assert "_balance" not in out.columns


def test_features_use_one_shuffle_for_all_windows(spark):
    rows = panel(spark, ["00"] * 4, [1.0] * 4, [0.0] * 4).filter("upb_orig > 0")
    plan = features.with_features(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("+- Sort [") == 1


def delinquency(spark, loan, values):
    days = months(date(2018, 1, 1), len(values))
    return spark.createDataFrame([(loan, d, v) for d, v in zip(days, values)],
                                 "loan_id string, reporting_period date, delq_num bigint")


def test_event_within_horizon(spark):
    out = labels.label_defaults(delinquency(spark, "A", [0] * 9 + [3] + [0] * 5), 12, 3)
    got = {r["reporting_period"]: r["target"] for r in out.collect()}
    assert got[date(2018, 1, 1)] == 1
    assert date(2018, 10, 1) not in got


def test_clean_loan_is_zero_and_tail_is_censored(spark):
    got = labels.label_defaults(delinquency(spark, "B", [0] * 20), 12, 3)
    assert [r["target"] for r in got.collect()] == [0] * 8
    assert labels.label_defaults(delinquency(spark, "C", [0] * 10), 12, 3).count() == 0


def test_lookahead_counts_rows_and_censoring_counts_months(spark):
    days = months(date(2018, 1, 1), 30)
    kept = [d for i, d in enumerate(days) if i == 0 or i >= 18]
    rows = [("G", d, 3 if d == days[20] else 0) for d in kept]
    frame = spark.createDataFrame(rows, "loan_id string, reporting_period date, delq_num bigint")
    first = labels.label_defaults(frame, 12, 3).orderBy("reporting_period").first()
    assert first["reporting_period"] == days[0] and first["target"] == 1


TERMINAL = "loan_id string, prepay_period date, default_period date, last_period date"


def prepay(spark, first, n, exits):
    frame = spark.createDataFrame([("A", d, 0) for d in months(first, n)],
                                  "loan_id string, reporting_period date, delq_num bigint")
    terminal = spark.createDataFrame([("A", *exits)], TERMINAL)
    return labels.label_prepayments(frame, terminal, 12)


def test_prepay_within_horizon(spark):
    end = date(2020, 6, 1)
    out = prepay(spark, date(2020, 1, 1), 6, (end, None, end)).collect()
    assert len(out) == 5 and all(r["target"] == 1 for r in out)
    assert end not in [r["reporting_period"] for r in out]


def test_default_first_is_censored(spark):
    end = date(2020, 4, 1)
    assert prepay(spark, date(2020, 1, 1), 4, (None, end, end)).count() == 0


def test_survivor_is_zero_until_the_open_tail(spark):
    out = prepay(spark, date(2020, 1, 1), 36, (None, None, date(2022, 12, 1)))
    got = out.agg(F.sum("target"), F.max("reporting_period"), F.count("*")).first()
    assert got[0] == 0 and got[1] == date(2021, 12, 1) and got[2] == 24


def test_open_window_is_dropped(spark):
    rows = [(d, int(i >= 12 or j == 0)) for i, d in enumerate(months(date(2022, 1, 1), 24))
            for j in range(20)]
    frame = spark.createDataFrame(rows, "reporting_period date, target int")
    rates = labels.default_rate_by_period(labels.drop_open_window(frame, 12), 10)
    assert rates.count() == 12 and rates.filter("dr > 0.9").count() == 0
