"""Costly steps run once per row, and once per query."""

from datetime import date
from math import inf, nan

from pyspark.sql import functions as F

from lossloom.operators import exposure, loss
from lossloom.operators.binning import WoeMap
from lossloom.params import LossSettings, ValidationSettings


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_backtest_takes_each_power_once(spark, monkeypatch):
    """Each horizon took its powers eight times per row."""
    frame = spark.createDataFrame(
        [(k, date(2018, m, 1), 1e5 * (1 - m / 400), 3.0 + k, 360.0 - m) for k in range(3) for m in range(1, 9)],
        "loan_id int, reporting_period date, upb_current double, note_rate double, remaining_term double")
    stored, plain = [], exposure.durable
    monkeypatch.setattr(exposure, "durable", lambda df: stored.append(plan_of(df)) or plain(df))
    out = {r["horizon"]: r for r in exposure.schedule_backtest(frame, (3, 6, 12)).collect()}
    assert {h: r["n"] for h, r in out.items()} == {3: 15, 6: 6}  # no loan has 12 more rows
    assert stored[0].upper().count("POWER(") == 4


def test_grid_reads_the_loans_once(spark):
    """The base case ran the kernel over all loans a second time."""
    loans = spark.createDataFrame([("a", 1, .02, 1e5, 4.0, 300.0), ("b", 3, .5, 2e5, 5.0, 200.0)],
                                  "loan_id string, stage int, pd12 double, upb double, rate double, term double")
    paths = {"base": (.01,) * 60, "downside": (.02,) * 60}
    cases = loss.sensitivity_cases(paths, {"base": .6, "downside": .4}, .3, .4, LossSettings(),
                                   ValidationSettings(weight_variants={}))
    out = loss.sensitivity_grid(loans, cases)
    assert "InPandas" not in plan_of(out)
    rows = out.orderBy("position").collect()
    assert len(rows) == len(cases) and rows[0]["delta_vs_base_pct"] == 0
    assert out.filter(F.col("total_ecl") <= 0).isEmpty()


def woe_map(n: int) -> WoeMap:
    """``n`` features: every third of single values, the others of ranges."""
    ranges = [{"kind": "numeric", "hi": h, "value": None, "woe": w}
              for h, w in [(None, .4), (-1.5, .1), (0.0, -.2), (2.0, .3), (3.0, .7), (5.0, .9), (8.0, 1.1), (9.0, 1.3)]]
    values = [{"kind": "discrete", "hi": None, "value": v, "woe": w}
              for v, w in [(2.0, .6), (0.0, .5), (-1.5, -.7), (7.0, .8), (8.0, .9), (9.0, 1.0), (10.0, 1.2)]]
    null = {"kind": "null", "hi": None, "value": None, "woe": -.9}
    return WoeMap({f"f{i}": [*(values if i % 3 == 0 else ranges), *([null] if i % 2 else [])]
                   for i in range(n)} | {"only_null": [null], "open": [dict(ranges[0])]})


def test_bins_are_found_as_by_their_conditions(spark):
    points = [-inf, -2.0, -1.5, -1.4, -0.0, 0.0, 5e-324, 1.9, 2.0, 2.0000000000000004, 9.0, 10.0, inf, nan, None]
    woe = woe_map(4)
    rows = spark.createDataFrame([tuple([x] * len(woe.bins)) for x in points],
                                 ", ".join(f"{f} double" for f in woe.bins))
    out = woe.transform(rows)
    assert out.columns == [*rows.columns, *[f"{f}_woe" for f in woe.bins]]
    wrong = out.select(*[(~F.col(f"{f}_woe").eqNullSafe(woe.column(f))).cast("int").alias(f) for f in woe.bins])
    assert list(wrong.agg(*[F.sum(f) for f in woe.bins]).first()) == [0] * len(woe.bins)


def test_bins_of_many_features_make_a_method_that_is_compiled(spark):
    """Java leaves methods of over 8,000 bytes to the interpreter; the conditions made one of 14,720 here."""
    woe = woe_map(16)
    rows = spark.range(40, numPartitions=1).select(*[F.when(F.col("id") % (i + 3) > 0, F.col("id") - 9.5).alias(f)
                                                      for i, f in enumerate(woe.bins)]).localCheckpoint()
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        scored = woe.transform(rows).agg(*[F.sum(f"{f}_woe") for f in woe.bins])
        stages = scored._jdf.queryExecution().debug().codegenToSeq()
        longest = max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert longest < 8000


def test_tally_labels_the_panel_once(spark, monkeypatch):
    """Its rate and its scores each took the windows of the labels."""
    from workload import common, q_cohort, q_models, q_oversight

    calls, plain = [], common.closed

    def counted(*a):
        calls.append(a)
        return plain(*a)

    for module in (common, q_cohort, q_oversight):
        monkeypatch.setattr(module, "closed", counted)
    row = q_oversight.v8(spark, "/root/testdata/sf0.001").first()
    assert len(calls) == 1 and row["n_advisory"] == 1


def test_month_state_stores_only_the_new_months(spark, monkeypatch):
    """The whole panel was stored, and read again for every month."""
    from workload import q_models

    stored, plain = [], q_models.durable

    def kept(df):
        out = plain(df)
        stored.append(out.agg(F.min("reporting_period"), F.max("reporting_period")).first())
        return out

    monkeypatch.setattr(q_models, "durable", kept)
    assert q_models.l6_new(spark, "/root/testdata/sf0.001").count() > 0
    assert [(str(a), str(b)) for a, b in stored] == [("2000-01-01", "2000-03-01")]


def test_prepay_dataset_is_stored_narrow(spark, monkeypatch):
    """All columns of the feature panel were stored with it."""
    from lossloom.plans import prepayment
    from workload import q_models

    stored, plain = [], prepayment.durable
    monkeypatch.setattr(prepayment, "durable", lambda df: stored.append(set(df.columns)) or plain(df))
    rows = q_models.l5(spark, "/root/testdata/sf0.001").collect()
    assert {(r["split"], r["target"]) for r in rows} == {(s, t) for s in ("train", "test") for t in (0, 1)}
    assert {"months_on_book", "incentive_burnout", "split"} <= stored[0]
    assert not {"state", "cum_principal_paid", "vintage"} & stored[0]
