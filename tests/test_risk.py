from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossloom.functions import amortization, normal, rates
from lossloom.operators import (
    exposure,
    loss,
    macro,
    monitoring,
    regression,
    scenarios,
    severity,
    staging,
    validation,
)
from lossloom.params import LossSettings, MonitoringSettings, ScenarioSettings, ValidationSettings
from tests.test_features_labels import months


def value(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


# ---- annuities, rates, normal law ----------------------------------------------------------


def walked(balance, yearly, payment, steps):
    """Balances month by month: interest in, payment out."""
    out = [balance]
    for _ in range(steps):
        out.append(out[-1] * (1 + yearly / 1200) - payment)
    return out


def test_schedule_pays_the_loan_off(spark):
    payment = value(spark, amortization.monthly_payment(F.lit(8.4e4), F.lit(7.5), 48))
    path = walked(8.4e4, 7.5, payment, 48)
    assert abs(path[-1]) < 1e-6
    for k in (1, 17, 47):
        left = value(spark, amortization.remaining_balance(F.lit(8.4e4), F.lit(7.5), 48, k))
        assert abs(left - path[k]) < 1e-6


def test_schedule_at_its_limits(spark):
    def left(balance, rate, term, after):
        return value(spark, amortization.remaining_balance(balance, rate, term, after))

    assert left(F.lit(9e3), F.lit(0.0), 45, 15) == 6000        # no interest: 200 a month
    assert abs(left(F.lit(7e4), F.lit(4.25), 60, 61)) < 1e-6   # after the end
    assert left(F.lit(0.0), F.lit(3.5), 24, 2) == 0
    assert left(F.lit(5e3), F.lit(3.5), 0, 2) == 0
    assert left(F.lit(None).cast("double"), F.lit(3.5), 24, 2) is None
    assert left(F.lit(5e3), F.lit(None).cast("double"), 24, 2) is None


def test_monthly_rates(spark):
    h = value(spark, rates.monthly_hazard(F.lit(0.12)))
    assert abs(1 - (1 - h) ** 12 - 0.12) < 1e-12
    assert value(spark, rates.monthly_hazard(F.lit(None).cast("double"))) is None
    assert rates.monthly_prepay_value(0.0) == 0.0
    assert abs(1 - (1 - rates.monthly_prepay_value(0.1)) ** 12 - 0.1) < 1e-12


def test_normal_law_round_trip(spark):
    ps = [1e-6, 1e-4, 0.005, 0.02, 0.08, 0.2, 0.5, 0.7, 0.999]
    frame = spark.createDataFrame([(p,) for p in ps], "p double")
    z = normal.implied_factor(F.col("p"), F.lit(0.02), 0.15)
    back = frame.select("p", normal.point_in_time_pd(F.lit(0.02), z, 0.15).alias("b"))
    assert all(abs(r["p"] - r["b"]) < 1e-12 for r in back.collect())
    known = {0.0: 0.5, 1.959963984540054: 0.975, -3.0: 0.0013498980316300933, 8.0: 1.0}
    for x, p in known.items():
        assert abs(value(spark, normal.normal_cdf(F.lit(x))) - p) < 1e-13
    pit = [value(spark, normal.point_in_time_pd(F.lit(0.02), F.lit(z), 0.15)) for z in (2.0, 0.0, -2.0)]
    assert pit == sorted(pit) and pit[0] < 0.02 < pit[2]


# ---- exposure ------------------------------------------------------------------------------


def test_schedule_backtest_reproduces_an_amortising_loan(spark):
    days = months(date(2018, 1, 1), 30)
    frame = spark.createDataFrame([("L", d, 5.0, float(360 - i), float(i)) for i, d in enumerate(days)],
                                  "loan_id string, reporting_period date, note_rate double, "
                                  "remaining_term double, k double")
    frame = frame.withColumn("upb_current", amortization.remaining_balance(
        F.lit(3e5), F.lit(5.0), 360, F.col("k")))
    out = exposure.schedule_backtest(frame, (3, 6, 12)).collect()
    assert {r["horizon"]: r["n"] for r in out} == {3: 27, 6: 24, 12: 18}
    assert all(r["median_abs_pct_err"] < 1e-9 and abs(r["actual_to_scheduled"] - 1) < 1e-9 for r in out)
    table = spark.createDataFrame([(3, 0.97), (24, 0.9)], "horizon int, actual_to_scheduled double")
    assert exposure.curtailment_factor(table).first()[0] == 0.9
    assert exposure.curtailment_factor(table.filter("horizon > 99")).first()[0] == 1.0


def test_latest_exposure_is_the_latest_valid_row(spark):
    rows = [("A", date(2020, 1, 1), 100.0, 4.0, 10.0), ("A", date(2020, 2, 1), 90.0, 4.0, 9.0),
            ("A", date(2020, 3, 1), 0.0, 4.0, 8.0), ("B", date(2020, 1, 1), 0.0, 4.0, 8.0)]
    frame = spark.createDataFrame(rows, "loan_id string, reporting_period date, upb_current double, "
                                        "int_rate_current double, remaining_months_to_maturity double")
    out = exposure.latest_exposure(frame).collect()
    assert [(r["loan_id"], r["upb"], r["term"]) for r in out] == [("A", 90.0, 9.0)]


# ---- severity ------------------------------------------------------------------------------


def stressed(spark):
    """Six losses a month at 0.2; in thirty months from March 2016 they are 0.7."""
    rows = []
    for k, d in enumerate(months(date(2013, 1, 1), 84)):
        rows += [(d, 0.7 if 38 <= k < 68 else 0.2)] * 6
    return spark.createDataFrame(rows, "default_period date, lgd double")


def test_worst_window_lies_in_the_stress(spark):
    worst = severity.worst_window(stressed(spark)).first()
    assert abs(worst["lgd"] - 0.7) < 1e-12
    assert date(2016, 3, 1) <= worst["window_start"] <= date(2016, 9, 1)
    few = stressed(spark).filter("default_period >= date '2019-06-01'")    # 42 losses
    assert severity.worst_window(few).count() == 0


def test_net_loss_rules(spark):
    base = {c: None for c in [*severity.BALANCES, *severity.COSTS, *severity.PROCEEDS]}
    cases = [
        {**base, "upb_at_the_time_of_removal": 100.0, "foreclosure_costs": 10.0, "net_sales_proceeds": 80.0},
        {**base, "upb_at_the_time_of_removal": 0.0, "upb_current": 50.0},
        {**base, "foreclosure_principal_write_off_amount": 20.0, "net_sales_proceeds": 90.0},
        {**base, "asset_recovery_costs": 5.0}]
    ddl = ", ".join(f"{c} double" for c in base)
    frame = spark.createDataFrame([tuple(c.values()) for c in cases], ddl)
    got = sorted((r["default_upb"], r["lgd"]) for r in severity.with_severity(frame).collect())
    assert got == [(20.0, 0.0), (100.0, 0.3)]
    reported = severity.with_severity(frame.withColumn(severity.REPORTED, F.lit(-25.0)))
    assert (50.0, 0.5) in [(r["default_upb"], r["lgd"]) for r in reported.collect()]


def test_severity_fit_recovers_an_exact_plane(spark):
    rows = [(45.0 + 4 * i, 0.5 + k, 0.004 * (45 + 4 * i) + 0.01 * (0.5 + k) - 0.1)
            for i in range(18) for k in range(5)]
    frame = spark.createDataFrame(rows, "mtm_ltv double, loan_age_years double, lgd double")
    fit = regression.fit_linear(frame, ["mtm_ltv", "loan_age_years"], "lgd")
    assert np.allclose([*fit.coefficients, fit.intercept], [0.004, 0.01, -0.1])
    buckets = {r["ltv_bucket"]: r["mean_lgd"] for r in severity.severity_by_bucket(frame).collect()}
    first = next(b for b in buckets if b.startswith("0-"))
    # 45, 49, 53 and 57 lie below 60: mean 51, mean age 2.5.
    assert abs(buckets[first] - (0.004 * 51 + 0.01 * 2.5 - 0.1)) < 1e-9
    down = severity.downturn_severity(frame, fit, spark.createDataFrame([], "lgd double")).first()
    assert down["uplift_ratio"] > 1 and down["empirical_lgd"] is None


def test_the_largest_downturn_candidate_wins(spark):
    columns = ("empirical_lgd double, model_downturn_lgd double, benchmark double, "
               "base_mean_lgd double")
    for row, driver in (((.41, .44, .3, .2), "model"), ((None, .21, .3, .2), "benchmark"),
                        ((.62, .44, .3, .2), "empirical")):
        got = severity.downturn_choice(spark.createDataFrame([row], columns)).first()
        assert got["driver"].startswith(driver) and got["downturn_lgd"] == max(x for x in row if x)


def test_severity_statistics(spark):
    frame = spark.createDataFrame([(x / 10,) for x in range(11)] + [(None,)], "lgd double")
    got = severity.severity_statistics(frame).first()
    assert got["n"] == 11 and abs(got["median"] - .5) < 1e-12 and abs(got["p90"] - .9) < 1e-12
    assert abs(got["std"] - .1 ** .5) < 1e-12


# ---- staging -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def staged(spark):
    rows = [
        ("calm", 0, .02, .021, 1),          # ratio 1.05, rise .001
        ("unknown", None, .02, .02, 1),
        ("late", 2, .002, .001, 2),         # past due, although its rate fell
        ("doubled", 0, .001, .002, 2),      # ratio 2 alone
        ("risen", 0, .2, .215, 2),          # rise .015 alone
        ("almost", 0, .1, .109, 1),
        ("defaulted", 3, .3, .1, 3),
        ("gone", 9, None, None, 3)]
    return staging.with_stage(spark.createDataFrame(
        rows, "loan_id string, delq_num bigint, pd_orig double, pd_now double, want int")).cache()


def test_stages(staged):
    assert staged.filter("stage <> want").count() == 0
    assert staged.filter("loan_id = 'unknown'").first()["is_default"] is None
    share = {r["stage"]: r["pct"] for r in staging.stage_distribution(staged).collect()}
    assert abs(share[2] - 37.5) < 0.01 and abs(sum(share.values()) - 100) < 0.05
    earlier = staged.select("loan_id", F.lit(2).alias("stage")).filter("loan_id <> 'gone'")
    assert staging.migration_matrix(staged, earlier).agg(F.sum("n")).first()[0] == 7


def test_snapshot_falls_back_to_current_pd(spark):
    rows = [("A", date(2020, 1, 1), None, 0, .02), ("A", date(2020, 2, 1), 1.0, 2, .05)]
    frame = spark.createDataFrame(rows, "loan_id string, reporting_period date, loan_age double, "
                                        "delq_num bigint, x double")
    out = staging.staged_inputs(frame, ["x"], lambda df: df.withColumn("pd", F.col("x"))).first()
    assert (out["pd_orig"], out["pd_now"], out["delq_num"]) == (.02, .05, 2)


# ---- scenarios -----------------------------------------------------------------------------


def test_macro_table(spark):
    rows = [("hpi", date(2020, 1 + m, 1 + 7 * w), 100.0 + m + w) for m in range(3) for w in range(2)]
    rows += [("real_gdp", date(2020, 1, 1), 10.0)]
    out = macro.monthly_macro(spark.createDataFrame(rows, "series string, day date, value double"),
                              ["hpi", "real_gdp"], end="2021-01-15").orderBy("reporting_period").collect()
    assert len(out) == 13 and out[0]["hpi"] == 100.5 and out[1]["real_gdp"] == 10.0
    assert abs(out[12]["hpi_yoy"] - (102.5 / 100.5 - 1) * 100) < 1e-12 and out[11]["hpi_yoy"] is None


def test_shock_ramp_and_latest_value(spark):
    frame = spark.createDataFrame([(date(2024, 1, 1), 4.5), (date(2024, 2, 1), 4.0), (date(2024, 3, 1), None)],
                                  "reporting_period date, unemployment double")
    base = macro.latest_values(frame, ["unemployment"])
    assert base.first()["unemployment"] == 4.0
    path = scenarios.macro_paths(base, ["unemployment"], ScenarioSettings(horizon=24))
    down = {r["month"]: r["unemployment"] for r in path.filter("scenario = 'downside'").collect()}
    assert abs(down[1] - (4 + 4 / 12)) < 1e-12 and down[12] == down[24] == 8.0


def z_paths(spark, base, down, up):
    return spark.createDataFrame([("base", .5, 1, base), ("downside", .25, 1, down), ("upside", .25, 1, up)],
                                 "scenario string, weight double, month int, z double")


def test_monotone_clamp(spark):
    out = scenarios.ordered_factors(z_paths(spark, 0.5, 0.9, 0.1))
    assert {r["z"] for r in out.collect()} == {0.5} and out.filter("adjusted").count() == 2
    assert scenarios.ordered_factors(z_paths(spark, .5, -.5, 1.5)).filter("adjusted").count() == 0


def test_multipliers_divide_by_the_weighted_start(spark):
    rows = [("mild", .6, 1, .02), ("harsh", .4, 1, .07), ("mild", .6, 2, .05), ("harsh", .4, 2, .05)]
    paths = spark.createDataFrame(rows, "scenario string, weight double, month int, pit_pd double")
    got = {(r["scenario"], r["month"]): r["multiplier"] for r in scenarios.multipliers(paths).collect()}
    level = .6 * .02 + .4 * .07     # 0.04 in month 1
    assert abs(got["mild", 1] - .02 / level) < 1e-12 and abs(got["harsh", 1] - .07 / level) < 1e-12
    assert abs(.6 * got["mild", 1] + .4 * got["harsh", 1] - 1) < 1e-12
    assert abs(got["mild", 2] - .05 / level) < 1e-12    # later months keep the first one's level


@pytest.mark.parametrize("up, down, ok", [(.01, .03, True), (.03, .01, False), (.02, .02, True)])
def test_ordering_check(spark, up, down, ok):
    rows = [("base", .5, 1, .02), ("upside", .2, 1, up), ("downside", .3, 1, down)]
    paths = spark.createDataFrame(rows, "scenario string, weight double, month int, pit_pd double")
    assert scenarios.ordering_check(paths).first()["ordering_ok"] == ok


# ---- loss ----------------------------------------------------------------------------------

LOANS = "loan_id string, pd12 double, upb double, rate double, term double, stage int"


def loss_by_hand(pd12, upb, rate, term, stage, case):
    h0, r = 1 - (1 - pd12) ** (1 / 12), rate / 1200
    near = life = 0.0
    for s, w in case.weights.items():
        alive = 1.0
        for t in range(1, case.horizon + 1):
            h = min(max(h0 * case.multipliers[s][t - 1], 0), 1)
            k = min(t, term)
            balance = upb * ((1 + r) ** term - (1 + r) ** k) / ((1 + r) ** term - 1)
            el = w * alive * h * case.lgd[s] * balance / (1 + r) ** t
            life += el
            near += el if t <= 12 else 0
            alive *= (1 - h) * (1 - case.smm)
    if stage >= 3:
        near = life = case.weighted_lgd * upb
    return near, life


def test_kernel_matches_a_plain_loop(spark):
    rng = np.random.default_rng(0)
    rows = [(f"L{i}", float(rng.uniform(0, .9)), float(rng.uniform(1e4, 4e5)), float(rng.uniform(2, 8)),
             float(rng.integers(5, 360)), int(rng.integers(1, 4))) for i in range(40)]
    paths = {"base": tuple(.01 + .0002 * t for t in range(60)), "downside": tuple(.03 + .002 * t for t in range(60))}
    case = loss.loss_case("x", paths, {"base": .7, "downside": .3}, .2, .4)
    got = {r["loan_id"]: r for r in loss.loan_losses(spark.createDataFrame(rows, LOANS), case).collect()}
    for loan, *inputs in rows:
        near, life = loss_by_hand(*inputs, case)
        assert np.isclose(got[loan]["ecl_12m"], near, rtol=1e-10)
        assert np.isclose(got[loan]["ecl_lifetime"], life, rtol=1e-10)
        assert np.isclose(got[loan]["ecl"], near if inputs[-1] == 1 else life, rtol=1e-10)


def test_one_month_is_plain_arithmetic(spark):
    """One month, no prepayment: loss = hazard x severity x scheduled balance, discounted."""
    hazard, balance = 1 - .4 ** (1 / 12), 2.4e4 - 2.4e4 / 24    # no interest: a 24th is repaid
    rows = [("one", .6, 2.4e4, 0.0, 24.0, 1), ("three", .6, 2.4e4, 0.0, 24.0, 3)]
    case = loss.loss_case("x", {"only": (.05,)}, {"only": 1.0}, .5, .5,
                          LossSettings(horizon=1, annual_cpr=0.0))
    got = {r["loan_id"]: r["ecl"] for r in loss.loan_losses(spark.createDataFrame(rows, LOANS), case).collect()}
    assert abs(got["one"] - hazard * .5 * balance) < 1e-9
    assert got["three"] == .5 * 2.4e4


def test_loans_without_a_loss_show_in_the_summary(spark):
    rows = [("known", .2, 5e4, 4.0, 120.0, 1), ("no rate", .2, 3e4, None, 120.0, 1),
            ("no pd", None, 2e4, 4.0, 120.0, 2)]
    case = loss.loss_case("x", {"only": (.05,) * 12}, {"only": 1.0}, .5, .5, LossSettings(horizon=12))
    losses = loss.loan_losses(spark.createDataFrame(rows, LOANS), case)
    total = loss.loss_summary(losses).filter("stage is null").first()
    assert (total["n_loans"], total["n_without_loss"], total["ead_without_loss"]) == (3, 2, 5e4)
    assert total["ead"] == 1e5 and total["ecl"] > 0


@pytest.fixture(scope="module")
def loans(spark):
    rows = [(f"N{i}", .003 + .0004 * (i % 37), 9e4 + 1500.0 * (i % 53), 2.5 + .25 * (i % 9),
             90.0 + 6 * (i % 31), 3 if i % 41 == 0 else 2 if i % 11 == 0 else 1) for i in range(330)]
    return spark.createDataFrame(rows, LOANS).cache()


PATHS = {"plain": (.012,) * 48, "good": (.007,) * 48, "bad": (.031,) * 48}
WEIGHTS = {"plain": .6, "good": .15, "bad": .25}


def test_coverage_of_stages(spark):
    rows = [(f"N{i}", .02, 1.1e5, 3.75, 240.0, 1 + i % 3) for i in range(12)]
    case = loss.loss_case("x", {"only": (.02,) * 36}, {"only": 1.0}, .45, .45, LossSettings(horizon=36))
    summary = loss.loss_summary(loss.loan_losses(spark.createDataFrame(rows, LOANS), case)).cache()
    coverage = {r["stage"]: r["coverage_pct"] for r in summary.collect()}
    assert coverage[1] < coverage[2] < coverage[3] and abs(coverage[3] - 45) < 1e-9
    assert validation.coverage_rises_by_stage(summary).first()["passed"]
    assert validation.stage3_matches_severity(summary, .45).first()["passed"]
    assert not validation.stage3_matches_severity(summary, .2).first()["passed"]
    swapped = summary.withColumn("coverage_pct", -F.col("coverage_pct"))
    assert not validation.coverage_rises_by_stage(swapped).first()["passed"]


def test_each_sensitivity_case_equals_its_own_run(spark, loans):
    levers = ValidationSettings(cpr_values=(.03, .3), horizon_values=(12, 36), downturn_lgd_values=(.5,),
                                weight_variants={"mostly bad": {"plain": .1, "good": .1, "bad": .8}})
    cases = loss.sensitivity_cases(PATHS, WEIGHTS, .22, .4, LossSettings(downside="bad"), levers)
    rows = {r["position"]: r for r in loss.sensitivity_grid(loans, cases).collect()}
    assert len(rows) == len(cases) == 7
    totals = [loss.loss_summary(loss.loan_losses(loans, c)).filter("stage is null").first()["ecl"]
              for _, _, c in cases]
    for k, total in enumerate(totals):
        assert np.isclose(rows[k]["total_ecl"], total)
        assert np.isclose(rows[k]["delta_vs_base_pct"], (total / totals[0] - 1) * 100, atol=1e-9)
    at = {(lever, v): totals[k] for k, (lever, v, _) in enumerate(cases)}
    assert at["annual_cpr", "0.3"] < at["annual_cpr", "0.03"]      # repaid loans cannot default
    assert at["horizon_months", "12"] < at["horizon_months", "36"]
    assert at["scenario_weights", "mostly bad"] > totals[0]


def test_loans_without_a_loss_are_counted_in_every_case(spark, loans):
    """Rates and probabilities may be missing: the balance stays, the loss is unknown."""
    cases = loss.sensitivity_cases(PATHS, WEIGHTS, .22, .4, LossSettings(downside="bad"),
                                   ValidationSettings(cpr_values=(.1,), horizon_values=(12,),
                                                      weight_variants={"mostly bad": {"plain": .1, "good": .1, "bad": .8}}))
    gone = loans.withColumn("pd12", F.when(F.col("stage") != 2, F.col("pd12")))
    missing = gone.filter("pd12 is null").agg(F.count(F.lit(1)), F.sum("upb")).first()
    assert missing[0] > 0
    whole = {r["position"]: r for r in loss.sensitivity_grid(loans, cases).collect()}
    assert {r["n_without_loss"] for r in whole.values()} == {0}
    for k, r in {r["position"]: r for r in loss.sensitivity_grid(gone, cases).collect()}.items():
        assert (r["n_without_loss"], r["ead_without_loss"]) == pytest.approx(tuple(missing))
        assert r["total_ecl"] < whole[k]["total_ecl"]
    case = loss.loss_case("x", PATHS, WEIGHTS, .22, .4, LossSettings(horizon=24, downside="bad"))
    for r in loss.monthly_profile(gone, case).collect():
        assert r["n_without_loss"] == missing[0]


def test_monthly_profile_adds_up_to_the_lifetime_loss(spark, loans):
    case = loss.loss_case("x", PATHS, WEIGHTS, .22, .4, LossSettings(horizon=48, downside="bad"))
    some = loans.filter("stage = 2")
    by_month = loss.monthly_profile(some, case)
    total = sum(WEIGHTS[r["scenario"]] * r["loss"] for r in by_month.collect())
    assert np.isclose(total, loss.loan_losses(some, case).agg(F.sum("ecl_lifetime")).first()[0])


# ---- validation and monitoring -------------------------------------------------------------


@pytest.mark.parametrize("least, passed", [(.81, True), (.83, False)])
def test_discrimination_takes_the_best_model(spark, least, passed):
    aucs = spark.createDataFrame([("tree", .74), ("line", .82)], "model string, auc double")
    assert validation.discrimination(aucs, least).first()["passed"] == passed


@pytest.mark.parametrize("mean, passed", [(.02, True), (.059, True), (.061, False), (.005, False)])
def test_effective_calibration_band(spark, mean, passed):
    book = spark.createDataFrame([(mean - .001,), (mean + .001,)], "pd_now double")
    assert validation.effective_calibration(book, .02, (.3, 3.0)).first()["passed"] == passed


def test_raw_calibration_only_advises(spark):
    kind = "n bigint, pred_pd double, obs_default double"
    far = validation.raw_calibration(spark.createDataFrame([(40, .5, .02), (60, .4, .03)], kind))
    none = validation.raw_calibration(spark.createDataFrame([], kind))
    assert not far.first()["passed"] and none.first()["passed"]
    assert {far.first()["severity"], none.first()["severity"]} == {"warn"}
    good = validation.discrimination(spark.createDataFrame([("m", .9)], "model string, auc double"), .8)
    assert tuple(validation.tally(validation.all_checks(good, far, none)).first()) == (1, 1, 2)


def quarter(start, n, rates, hits):
    """``n`` rows that go through ``rates``; the first ``hits`` of them default."""
    return [(start, rates[i % len(rates)], int(i < hits)) for i in range(n)]


def test_lights_of_backtest_and_drift(spark):
    low, high = (.012, .018, .024, .03), (.2, .3, .35, .4)
    rows = (quarter(date(2021, 1, 1), 600, low, 13) + quarter(date(2021, 4, 1), 600, low, 7)
            + quarter(date(2021, 7, 1), 600, high, 190) + quarter(date(2021, 10, 1), 40, high, 40))
    panel = spark.createDataFrame(rows, "period date, pred_pd double, target int")
    m = MonitoringSettings(min_n=500)
    back = monitoring.backtest(panel, m)
    # .021 predicted: 13 / 600 = .0217 observed; 7 / 600 = .0117 is 1.8 times too low; .3125: .3167.
    assert {r["period"].month: r["rag"] for r in back.collect()} == {1: "GREEN", 4: "AMBER", 7: "GREEN"}
    drift = monitoring.score_stability(panel, m)
    assert {r["to"].month: r["rag"] for r in drift.collect()} == {4: "GREEN", 7: "RED", 10: "GREEN"}
    every = monitoring.lights(back, drift)
    assert every.count() == 6
    assert tuple(monitoring.status(every).first())[1] == "RED"
    assert tuple(monitoring.breaches(every).first())[0] == 1


def test_status_uses_the_newest_light_of_each_source(spark):
    rows = [("backtest", date(2022, m, 1), rag) for m, rag in ((1, "RED"), (4, "AMBER"), (7, "GREEN"))]
    rows += [("psi", date(2022, 4, 1), "RED"), ("psi", date(2022, 7, 1), "GREEN")]
    schema = "source string, period date, rag string"
    assert tuple(monitoring.status(spark.createDataFrame(rows, schema)).first()) == ("GREEN", "RED")
    assert tuple(monitoring.status(spark.createDataFrame([], schema)).first()) == ("n/a", "n/a")


def test_delinquency_trend_ignores_unknown(spark):
    panel = spark.createDataFrame([(date(2022, 1, 1), d) for d in (0, 0, 1, 3, None)], "period date, delq_num bigint")
    row = monitoring.delinquency_trend(panel).first()
    assert (row["n"], row["share_30dpd"], row["share_90dpd"]) == (5, .5, .25)
