"""Severity, exposure, point-in-time default rates, staging, scenarios and expected loss."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossloom.functions import amortization, normal, rates
from lossloom.operators import (
    exposure,
    loss,
    macro,
    regression,
    scenarios,
    severity,
)
from lossloom.operators.models import column_scorer
from lossloom.params import LgdSettings, ScenarioSettings
from workload import sql, tables
from workload.common import (
    RESPONSE,
    RESPONSE_SQL,
    RHO,
    SCENARIOS,
    book,
    closed,
    feat,
    lgd,
    long_run_rate,
    losses,
    macro_table,
    score,
    snapshot,
    staged,
)
from workload.q_cohort import LOSS_SQL, flat_case
from workload.q_models import OLS2_SQL
from workload.q_order import WINDOWS_SQL
from workload.registry import query

# ---- severity ------------------------------------------------------------------------------


@query("r1_default_balance", "select loan_id, default_upb from @losses")
def r1(spark, sf):
    return losses(spark, sf).select("loan_id", "default_upb")


@query("r2_net_loss", "select loan_id, round(net_loss / 7, 4) as net_loss from @losses")
def r2(spark, sf):
    return losses(spark, sf).select("loan_id", F.round(F.col("net_loss") / 7, 4).alias("net_loss"))


@query("r3_severity", """
select loan_id, round(lgd_raw, 8) as lgd_raw, round(lgd, 8) as lgd from @losses""")
def r3(spark, sf):
    return losses(spark, sf).select("loan_id", F.round("lgd_raw", 8).alias("lgd_raw"),
                                    F.round("lgd", 8).alias("lgd"))


@query("r4_current_ltv", """
select loan_id, round(mtm_ltv, 6) as mtm_ltv, loan_age_years, ltv_orig, fico_orig, state from @lgd""")
def r4(spark, sf):
    return lgd(spark, sf).select("loan_id", F.round("mtm_ltv", 6).alias("mtm_ltv"),
                                 "loan_age_years", "ltv_orig", "fico_orig", "state")


@query("r6_empirical_downturn", f"""
select window_start, window_end, n_obs, round(lgd, 8) as lgd from ({WINDOWS_SQL})
where n_obs >= 100 order by lgd desc, window_end limit 1""")
def r6(spark, sf):
    return severity.worst_window(losses(spark, sf), 24, 100).withColumn("lgd", F.round("lgd", 8))


@query("r7_downturn_severity", f"""
with {OLS2_SQL},
c as (select (select max(lgd) from ({WINDOWS_SQL}) where n_obs >= 100) as empirical_lgd,
    avg(least(greatest(b0 + b1 * mtm_ltv + b2 * loan_age_years, 5e-2), 1)) as base_mean_lgd,
    avg(least(greatest(b0 + b1 * (mtm_ltv / 8e-1) + b2 * loan_age_years, 5e-2), 1)) as model_downturn_lgd,
    35e-2 as benchmark from @lgd join ols on true)
select round(base_mean_lgd, 8) as base_mean_lgd, round(model_downturn_lgd, 8) as model_downturn_lgd,
  round(empirical_lgd, 8) as empirical_lgd, benchmark,
  case when empirical_lgd = top then 'empirical' when model_downturn_lgd = top then 'model'
    else 'benchmark' end as driver, round(top, 8) as downturn_lgd,
  round(top / base_mean_lgd, 6) as uplift_ratio
from (select *, greatest(empirical_lgd, model_downturn_lgd, benchmark) as top from c)""")
def r7(spark, sf):
    from lossloom.operators.durable import durable

    rows = durable(lgd(spark, sf))
    fit = regression.fit_linear(rows, ["mtm_ltv", "loan_age_years"], "lgd")
    out = severity.downturn_severity(rows, fit, severity.worst_window(rows), LgdSettings())
    return out.select(
        *[F.round(c, 8).alias(c) for c in ("base_mean_lgd", "model_downturn_lgd", "empirical_lgd",
                                           "downturn_lgd")],
        "benchmark", "driver", F.round("uplift_ratio", 6).alias("uplift_ratio"))


# ---- exposure ------------------------------------------------------------------------------


def balance_sql(b: str, r: str, n: str, k: str) -> str:
    return (f"case when {b} <= 0 or {n} <= 0 then 0e0 else greatest({b} * (pow(1 + {r} / 1e2 / 12e0, {n}) "
            f"- pow(1 + {r} / 1e2 / 12e0, least({k}, {n}))) / (pow(1 + {r} / 1e2 / 12e0, {n}) - 1), 0e0) end")


@query("r8_monthly_payment", """
select loan_id, round(case when loan_id % 9 = 0 then upb_orig / 360
  else upb_orig * (int_rate_orig / 1e2 / 12e0) / (1 - pow(1 + int_rate_orig / 1e2 / 12e0, -360)) end, 6)
  as payment from @loans""")
def r8(spark, sf):
    rate = F.when(F.col("loan_id") % 9 == 0, 0.0).otherwise(F.col("int_rate_orig"))
    return tables.loans(spark, sf).select(
        "loan_id", F.round(amortization.monthly_payment("upb_orig", rate, 360), 6)
        .alias("payment"))


@query("r9_remaining_balance", f"""
select loan_id, round(case when loan_id % 9 = 0 then upb_orig * (360 - 12) / 360 else
  {balance_sql('upb_orig', 'int_rate_orig', '360', '12')} end, 6) as after_year from @loans""")
def r9(spark, sf):
    rate = F.when(F.col("loan_id") % 9 == 0, 0.0).otherwise(F.col("int_rate_orig"))
    return tables.loans(spark, sf).select("loan_id", F.round(
        amortization.remaining_balance("upb_orig", rate, 360, 12), 6).alias("after_year"))


@query("r10_balance_path", f"""
select month, count(*) as n, round(avg(ead), 3) as ead from (
  select month, 95e-2 * {balance_sql('upb_current', 'note_rate', 'remaining_term', 'month')} as ead
  from (select loan_id, upb as upb_current, rate as note_rate, term as remaining_term from @latest)
  join (select unnest(range(1, 25)) as month) on true) group by month""")
def r10(spark, sf):
    loans = exposure.latest_exposure(tables.monthly(spark, sf)).withColumnsRenamed(
        {"upb": "upb_current", "rate": "note_rate", "term": "remaining_term"})
    return exposure.projected_exposure(loans, 24, 0.95).groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("ead"), 3).alias("ead"))


BACKTEST_EAD = f"""pairs as (
  select h as horizon, {balance_sql('upb_current', 'note_rate', 'remaining_term', 'h')} as pred,
    case h when 3 then a3 when 6 then a6 when 12 then a12 else a24 end as actual
  from (select *, lead(upb_current, 3) over w as a3, lead(upb_current, 6) over w as a6,
      lead(upb_current, 12) over w as a12, lead(upb_current, 24) over w as a24
    from @exposures window w as (partition by loan_id order by reporting_period))
  join (values (3), (6), (12), (24)) v(h) on true)"""


@query("r11_schedule_backtest", f"""
with {BACKTEST_EAD}
select horizon, count(*) as n, round(avg(pred), 3) as mean_pred, round(avg(actual), 3) as mean_actual,
  round(avg(abs(pred - actual)), 3) as mae,
  round(median(abs(pred - actual) / greatest(actual, 1)), 8) as median_abs_pct_err,
  round(median(actual / greatest(pred, 1)), 8) as actual_to_scheduled
from pairs where actual is not null and pred > 0 group by horizon""")
def r11(spark, sf):
    out = exposure.schedule_backtest(exposure.exposure_panel(tables.monthly(spark, sf)))
    return out.select("horizon", "n", *[F.round(c, 3).alias(c)
                                        for c in ("mean_pred", "mean_actual", "mae")],
                      *[F.round(c, 8).alias(c)
                        for c in ("median_abs_pct_err", "actual_to_scheduled")])


@query("r12_curtailment_factor", f"""
with {BACKTEST_EAD}
select round(median(actual / greatest(pred, 1)), 8) as curtailment_factor
from pairs where actual is not null and pred > 0 and horizon = 12""")
def r12(spark, sf):
    out = exposure.schedule_backtest(exposure.exposure_panel(tables.monthly(spark, sf)))
    return exposure.curtailment_factor(out).select(
        F.round("curtailment_factor", 8).alias("curtailment_factor"))


@query("r13_exposure_panel", """
select loan_id, count(*) as n, round(avg(ln(upb_current)), 6) as log_upb, min(remaining_term) as term
from @exposures group by loan_id""")
def r13(spark, sf):
    return exposure.exposure_panel(tables.monthly(spark, sf)).groupBy("loan_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.ln("upb_current")), 6).alias("log_upb"),
        F.min("remaining_term").alias("term"))


# ---- point-in-time rates -------------------------------------------------------------------


@query("r5_scored_panel", """
select vintage, count(*) as n, round(avg(p), 8) as pd from (select vintage, """ + sql.SCORE + """ as p
  from @feat) group by vintage""")
def r5(spark, sf):
    return column_scorer(score())(feat(spark, sf)).groupBy("vintage").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("pd"), 8).alias("pd"))


PIT_SQL = (f"select *, {sql.inside('pd')} as q from (select loan_id, pd_now as pd, "
           "cast(loan_id % 41 - 20 as double) / 1e1 as z from @snapshot)")


@query("r14_point_in_time_pd", f"""
select loan_id, round({sql.cdf('x')}, 9) as pit_pd from (
  select loan_id, ({sql.ppf('q')} - sqrt({RHO}e0) * z) / sqrt(1 - {RHO}e0) as x from ({PIT_SQL}))""")
def r14(spark, sf):
    z = (F.col("loan_id") % 41 - 20).cast("double") / 10.0
    return snapshot(spark, sf).select("loan_id", F.round(
        normal.point_in_time_pd(F.col("pd_now"), z, RHO), 9).alias("pit_pd"))


Z_SQL = f"""zs as materialized (
  select reporting_period, dr, n, ({sql.ppf('qt')} - sqrt(1 - {RHO}e0) * {sql.ppf('qd')}) / sqrt({RHO}e0) as z
  from (select reporting_period, dr, n, {sql.inside('dr')} as qd, {sql.inside('ttc')} as qt from (
    select reporting_period, avg(target) as dr, count(*) as n from @closed group by 1
    having count(*) >= 500) join (select avg(target) as ttc from @closed) on true))"""


@query("r15_implied_factor", f"""
with {Z_SQL} select reporting_period, dr, n, round(z, 8) as z from zs""")
def r15(spark, sf):
    from lossloom.plans.default_model import factor_series

    rows = closed(spark, sf)
    ttc = rows.agg(F.avg("target")).first()[0]
    return factor_series(rows, ttc).withColumn("z", F.round("z", 8))


# ---- staging -------------------------------------------------------------------------------


@query("e1_stage_rule", """
select loan_id, stage, is_default, sicr_backstop_30dpd, sicr_pd_deterioration from @staged""")
def e1(spark, sf):
    return staged(spark, sf).select("loan_id", "stage", "is_default", "sicr_backstop_30dpd",
                                    "sicr_pd_deterioration")


@query("e2_staged_snapshot", "select loan_id, reporting_period, delq_num, pd_orig, pd_now from @snapshot")
def e2(spark, sf):
    return snapshot(spark, sf)


@query("e2_snapshot_at_period", f"""
select s.loan_id, reporting_period, delq_num, pd_now, pd_orig from
  (select loan_id, reporting_period, delq_num, {sql.SCORE} as pd_now from @feat
   where reporting_period = date '1999-06-01') s
join (select loan_id, pd_orig from @snapshot) using (loan_id)""")
def e2_period(spark, sf):
    return snapshot(spark, sf, "1999-06-01")


@query("e3_exposure_inputs", """
select term, count(*) as n, round(avg(upb), 4) as upb, round(avg(rate), 8) as rate from @latest group by term""")
def e3(spark, sf):
    return exposure.latest_exposure(tables.monthly(spark, sf)).groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("upb"), 4).alias("upb"),
        F.round(F.avg("rate"), 8).alias("rate"))


# ---- scenarios -----------------------------------------------------------------------------

MACRO_FEATURES = list(RESPONSE.features)


def baseline(spark, sf):
    return macro.latest_values(macro_table(spark, sf), MACRO_FEATURES)


BASE_SQL = "base as materialized (select " + ", ".join(
    f"arg_max({f}, reporting_period) filter (where {f} is not null) as {f}"
    for f in MACRO_FEATURES) + " from @macro)"


def shock(name, f):
    return f"{float(SCENARIOS.shocks[name][f])!r}e0"


PATHS_SQL = BASE_SQL + ", paths as materialized (select scenario, weight, month, " + ", ".join(
    f"{f} + s_{f} * least(month / 12e0, 1e0) as {f}" for f in MACRO_FEATURES) + \
    " from base join (values " + ", ".join(
        f"('{s}', {w}e0, " + ", ".join(shock(s, f) for f in MACRO_FEATURES) + ")"
        for s, w in SCENARIOS.weights.items()) + \
    ") v(scenario, weight, " + ", ".join(f"s_{f}" for f in MACRO_FEATURES) + \
    ") on true join (select unnest(range(1, 61)) as month) on true)"

FACTOR_SQL = PATHS_SQL + f""", raw as (select scenario, weight, month, {RESPONSE_SQL} as z from paths),
  clamped as materialized (select scenario, weight, month, case when scenario = 'downside' then least(z, b)
    when scenario = 'upside' then greatest(z, b) else z end as z, z as old from
    (select *, max(case when scenario = 'base' then z end) over (partition by month) as b from raw))"""

PIT_PATHS_SQL = FACTOR_SQL + f""", pit as materialized (
  select scenario, weight, month, z, {sql.cdf('x')} as pit_pd from (
    select *, ({sql.ppf('qt')} - sqrt({RHO}e0) * z) / sqrt(1 - {RHO}e0) as x from
      (select *, {sql.inside('ttc')} as qt from clamped
       join (select avg(target) as ttc from @closed) on true)))"""


def factor_paths(spark, sf, clamp=True):
    paths = scenarios.factor_paths(baseline(spark, sf), RESPONSE)
    return scenarios.ordered_factors(paths) if clamp else paths


def pit_paths(spark, sf):
    ttc = long_run_rate(spark, sf).scalar()
    return scenarios.default_paths(factor_paths(spark, sf), ttc, RHO)


@query("e4_shock_ramp", f"""
with {PATHS_SQL}
select month, round((p.unemployment - b.unemployment) / 4e0, 8) as share from paths p join base b on true
where scenario = 'downside'""")
def e4(spark, sf):
    base = baseline(spark, sf).select(F.col("unemployment").alias("b"), *MACRO_FEATURES)
    paths = scenarios.macro_paths(base, MACRO_FEATURES)
    anchor = base.select("b").scalar()
    return paths.filter("scenario = 'downside'").select(
        "month", F.round((F.col("unemployment") - anchor) / 4.0, 8).alias("share"))


@query("e5_macro_paths", f"with {PATHS_SQL} select scenario, weight, month, " + ", ".join(
    f"round({f}, 8) as {f}" for f in MACRO_FEATURES) + " from paths")
def e5(spark, sf):
    rows = scenarios.macro_paths(baseline(spark, sf), MACRO_FEATURES)
    return rows.select("scenario", "weight", "month",
                       *[F.round(f, 8).alias(f) for f in MACRO_FEATURES])


@query("e6_factor_paths", f"""
with {FACTOR_SQL} select scenario, weight, month, round(old, 8) as z from clamped""")
def e6(spark, sf):
    return factor_paths(spark, sf, clamp=False).withColumn("z", F.round("z", 8))


@query("e6_factor_overlay", f"""
with {BASE_SQL}
select scenario, month, round({RESPONSE_SQL} + shift, 8) as z from base
join (values ('base', 0e0), ('upside', 5e-1), ('downside', -1e0)) v(scenario, shift) on true
join (select unnest(range(1, 61)) as month) on true""")
def e6_overlay(spark, sf):
    rows = scenarios.factor_paths(baseline(spark, sf), RESPONSE, ScenarioSettings(mode="z_overlay"))
    return rows.select("scenario", "month", F.round("z", 8).alias("z"))


@query("e7_monotone_clamp", f"""
with {FACTOR_SQL} select scenario, month, round(z, 8) as z,
  abs(z - old) > 1e-8 + 1e-5 * abs(old) as adjusted from clamped""")
def e7(spark, sf):
    return factor_paths(spark, sf).select("scenario", "month", F.round("z", 8).alias("z"),
                                          "adjusted")


@query("e8_default_paths", f"""
with {PIT_PATHS_SQL} select scenario, month, round(pit_pd, 9) as pit_pd from pit""")
def e8(spark, sf):
    return pit_paths(spark, sf).select("scenario", "month", F.round("pit_pd", 9).alias("pit_pd"))


@query("e8_weighted_path", f"""
with {PIT_PATHS_SQL}
select month, round(sum(weight * pit_pd), 9) as weighted_pit_pd from pit group by month""")
def e8_weighted(spark, sf):
    return scenarios.weighted_path(pit_paths(spark, sf)).withColumn(
        "weighted_pit_pd", F.round("weighted_pit_pd", 9))


@query("e9_ordering_check", f"""
with {PIT_PATHS_SQL}, m as (select max(case when scenario = 'base' then pit_pd end) as base,
  max(case when scenario = 'upside' then pit_pd end) as upside,
  max(case when scenario = 'downside' then pit_pd end) as downside from pit where month = 12)
select round(base, 9) as base, round(upside, 9) as upside, round(downside, 9) as downside,
  downside >= base and base >= upside as ordering_ok from m""")
def e9(spark, sf):
    out = scenarios.ordering_check(pit_paths(spark, sf))
    return out.withColumns({c: F.round(c, 9) for c in ("base", "upside", "downside")})


@query("e10_monthly_rates", """
select stage, count(*) as n,
  round(avg(1 - pow(1 - least(greatest(pd12, 0e0), 999999e-6), 1e0 / 12)), 10) as hazard,
  round(avg(1 - pow(1 - least(greatest(cpr, 0e0), 999999e-6), 1e0 / 12)), 10) as smm,
  round(avg(rate / 1e2 / 12e0), 10) as discount
from (select *, rate / 5e1 as cpr from @book) group by stage""")
def e10(spark, sf):
    return book(spark, sf).withColumn("cpr", F.col("rate") / 50.0).groupBy("stage").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(rates.monthly_hazard("pd12")), 10).alias("hazard"),
        F.round(F.avg(rates.monthly_prepay("cpr")), 10).alias("smm"),
        F.round(F.avg(rates.monthly_rate("rate")), 10).alias("discount"))


@query("e11_multipliers", f"""
with {PIT_PATHS_SQL}
select scenario, month, round(pit_pd / (select sum(weight * pit_pd) from pit where month = 1), 8)
  as multiplier from pit""")
def e11(spark, sf):
    from lossloom.operators.durable import durable

    return scenarios.multipliers(durable(pit_paths(spark, sf))).select(
        "scenario", "month", F.round("multiplier", 8).alias("multiplier"))


@query("e12_loan_losses", f"""
with {LOSS_SQL}
select loan_id, stage, round(ecl_12m, 5) as ecl_12m, round(ecl_lifetime, 5) as ecl_lifetime,
  round(ecl, 5) as ecl from loan_ecl""")
def e12(spark, sf):
    out = loss.loan_losses(book(spark, sf), flat_case(spark, sf))
    return out.select("loan_id", "stage", *[F.round(c, 5).alias(c)
                                            for c in ("ecl_12m", "ecl_lifetime", "ecl")])


@query("e13_scenario_severity", """
select scenario, round(case when scenario = 'downside' then greatest(m, 35e-2) else m end, 8) as lgd
from (select avg(lgd) as m from @losses)
join (values ('base'), ('upside'), ('downside')) v(scenario) on true""")
def e13(spark, sf):
    stats = severity.severity_statistics(losses(spark, sf)).select("mean").first()
    paths = {s: (1.0,) for s in SCENARIOS.weights}
    case = loss.loss_case("x", paths, SCENARIOS.weights, stats["mean"], max(stats["mean"], 0.35))
    return spark.createDataFrame(list(case.lgd.items()), "scenario string, lgd double").withColumn(
        "lgd", F.round("lgd", 8))


@query("e14_loan_inputs", """
select loan_id, stage, pd12, round(upb, 6) as upb, rate, term from @book""")
def e14(spark, sf):
    return book(spark, sf).withColumn("upb", F.round("upb", 6))


@query("j12_scenario_months", f"""
with {LOSS_SQL}
select scenario, t as month, count(*) as n, round(avg(s * h * lgd * v), 8) as loss from alive group by 1, 2""")
def j12(spark, sf):
    """Drill-down: average loss per scenario and month, summed inside the kernel's own blocks."""
    return loss.monthly_profile(book(spark, sf), flat_case(spark, sf)).select(
        "scenario", "month", "n", F.round(F.col("loss") / F.col("n"), 8).alias("loss"))
