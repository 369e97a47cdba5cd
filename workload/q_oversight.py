"""Validation, sensitivity, monitoring and result views."""

from __future__ import annotations


from pyspark.sql import functions as F

from lossloom.operators import (
    drift,
    labels,
    loss,
    metrics,
    monitoring,
    scenarios,
    severity,
    validation,
)
from lossloom.operators.durable import durable, durable_columns
from lossloom.params import ValidationSettings
from lossloom.sources import results
from workload.common import (
    BASE_LGD,
    DOWNTURN_LGD,
    LOSS,
    SCENARIOS,
    book,
    closed,
    labelled,
    long_run_rate,
    losses,
    scored,
    snapshot,
    staged,
)
from workload.q_cohort import BACKTEST_SQL, LOSS_SQL, PATH_SQL, backtest_panel, flat_case
from workload.q_models import RANKED_SQL, slices
from workload.q_quality import edges_sql, psi_sql
from workload.q_risk import PIT_PATHS_SQL, pit_paths
from workload.registry import query


def verdict(rows):
    return rows.select("check", "passed", "severity")


def summary(spark, sf, stages=None, rows=None):
    return durable(loss.loss_summary(loss.loan_losses(book(spark, sf, stages),
                                                      flat_case(spark, sf, rows))))


WEIGHTED_LGD = 0.75 * BASE_LGD + 0.25 * DOWNTURN_LGD
COVERAGE_SQL = f"""with {LOSS_SQL}, cover as (
  select max(case when stage = 1 then c end) as s1, max(case when stage = 2 then c end) as s2,
    max(case when stage = 3 then c end) as s3, max(case when stage is null then c end) as total
  from (select stage, sum(ecl) / sum(upb) * 100 as c from loan_ecl group by rollup (stage)))"""


@query("v1_coverage_by_stage", COVERAGE_SQL + """
select 'coverage_monotonic_by_stage' as "check", s1 <= s2 and s2 <= s3 as passed, 'error' as severity
from cover""")
def v1(spark, sf):
    return verdict(validation.coverage_rises_by_stage(summary(spark, sf)))


@query("v2_stage3_severity", COVERAGE_SQL + f"""
select 'stage3_equals_weighted_lgd' as "check", abs(s3 - {WEIGHTED_LGD * 100}) <= 0.5 as passed,
  'error' as severity from cover""")
def v2(spark, sf):
    return verdict(validation.stage3_matches_severity(summary(spark, sf), WEIGHTED_LGD))


@query("v3_coverage_range", COVERAGE_SQL + """
select 'portfolio_coverage_in_range' as "check", total between 5e-2 and 2 as passed, 'error' as severity
from cover""")
def v3(spark, sf):
    return verdict(validation.coverage_in_range(summary(spark, sf)))


@query("v4_scenario_order", f"""
with {PIT_PATHS_SQL}
select 'scenario_pd_ordering' as "check", max(case when scenario = 'downside' then pit_pd end) >=
  max(case when scenario = 'base' then pit_pd end) and max(case when scenario = 'base' then pit_pd end) >=
  max(case when scenario = 'upside' then pit_pd end) as passed, 'error' as severity from pit where month = 12""")
def v4(spark, sf):
    return verdict(validation.scenario_order(scenarios.ordering_check(durable(
        pit_paths(spark, sf)))))


def two_models(spark, sf):
    rows = scored(spark, sf).select("target", F.explode(F.array(
        F.struct(F.lit("formula").alias("model"), F.col("p").alias("p")),
        F.struct(F.lit("late").alias("model"), (F.col("delq_num") / 10.0).alias("p")))).alias("s"))
    rows = rows.select("target", "s.model", "s.p")
    return metrics.ranking_metrics(metrics.score_counts(rows, "target", "p", ["model"]), ["model"])


@query("v5_discrimination", f"""
with {RANKED_SQL}
select 'pd_discrimination_auc' as "check",
  sum(bad * (good_below + good / 2)) / (max(tb) * max(tg)) >= 7e-1 as passed, 'error' as severity
from ranked""")
def v5(spark, sf):
    m = metrics.ranking_metrics(slices(spark, sf)).withColumn("model", F.lit("formula"))
    return verdict(validation.discrimination(m))


@query("v6_effective_calibration", """
select 'effective_pd_calibration' as "check", (select avg(pd_now) from @snapshot)
  / (select avg(target) from @closed) between 3e-1 and 3 as passed, 'error' as severity""")
def v6(spark, sf):
    ttc = long_run_rate(spark, sf).first()[0]
    return verdict(validation.effective_calibration(snapshot(spark, sf), ttc))


@query("v7_raw_calibration", """
select 'pd_calibration_band_raw' as "check", avg(p) / avg(target) between 3e-1 and 3 as passed,
  'warn' as severity from @scored""")
def v7(spark, sf):
    return verdict(validation.raw_calibration(metrics.calibration_table(slices(spark, sf))))


@query("v8_check_tally", COVERAGE_SQL + """
select cast(s1 <= s2 and s2 <= s3 as bigint) + cast(total between 5e-2 and 2 as bigint) as n_error_passed,
  2 as n_error_checks, 1 as n_advisory from cover""")
def v8(spark, sf):
    rows = closed(spark, sf)  # for the long-run rate and the scores
    s = summary(spark, sf, rows=rows)
    table = metrics.calibration_table(slices(spark, sf, rows))
    return validation.tally(validation.all_checks(
        validation.coverage_rises_by_stage(s), validation.coverage_in_range(s),
        validation.raw_calibration(table)))


@query("v9_migration_psi", f"""
with sides as (select 0 as side, pd_orig as x from @snapshot union all select 1, pd_now from @snapshot),
{edges_sql('sides', 'side', 'x', 'pd')}
select round(psi, 8) as psi from ({psi_sql('sides', 'side', 'x', 'pd')})""")
def v9(spark, sf):
    return drift.stability_of_two(snapshot(spark, sf), "pd_orig", "pd_now").withColumn(
        "psi", F.round("psi", 8))


GRID = ValidationSettings(cpr_values=(0.0, 0.2), horizon_values=(36,), downturn_lgd_values=(0.45,),
                          weight_variants={"severe": {"base": 0.3, "upside": 0.1,
                                                      "downside": 0.6}})


def grid_paths(spark, sf):
    case = flat_case(spark, sf)
    return {s: tuple(m for m in path) for s, path in case.multipliers.items()}


GRID_CASES = [  # position, cpr, horizon, downturn severity, weights
    (0, "1e-1", 60, DOWNTURN_LGD, (0.5, 0.25, 0.25)), (1, "0e0", 60, DOWNTURN_LGD, (0.5, 0.25, 0.25)),
    (2, "2e-1", 60, DOWNTURN_LGD, (0.5, 0.25, 0.25)), (3, "1e-1", 36, DOWNTURN_LGD, (0.5, 0.25, 0.25)),
    (4, "1e-1", 60, 0.45, (0.5, 0.25, 0.25)), (5, "1e-1", 60, DOWNTURN_LGD, (0.3, 0.1, 0.6))]
EVEN = (0.5, 0.25, 0.25)
LEVER_CASES = [(0, "1e-1", 60, DOWNTURN_LGD, EVEN), (1, "0e0", 60, DOWNTURN_LGD, EVEN),
               (2, "5e-2", 60, DOWNTURN_LGD, EVEN), (3, "1e-1", 60, DOWNTURN_LGD, EVEN),
               (4, "2e-1", 60, DOWNTURN_LGD, EVEN), (5, "1e-1", 36, DOWNTURN_LGD, EVEN),
               (6, "1e-1", 48, DOWNTURN_LGD, EVEN), (7, "1e-1", 60, DOWNTURN_LGD, EVEN),
               (8, "1e-1", 60, 0.30, EVEN), (9, "1e-1", 60, 0.35, EVEN), (10, "1e-1", 60, 0.45, EVEN),
               (11, "1e-1", 60, DOWNTURN_LGD, EVEN), (12, "1e-1", 60, DOWNTURN_LGD, (0.4, 0.2, 0.4)),
               (13, "1e-1", 60, DOWNTURN_LGD, (0.3, 0.1, 0.6))]


def case_rows(cases):
    return ", ".join(
        f"({i}, {cpr}, {h}, '{s}', {w}e0, {d if s == 'downside' else BASE_LGD}e0)"
        for i, cpr, h, d, ws in cases for s, w in zip(("base", "upside", "downside"), ws))


def grid_sql(given):
    return f"""
with paths as materialized ({PATH_SQL}),
cases as (select * from (values {case_rows(given)}) v(position, cpr, horizon, scenario, w, l)),
anchors as (select position, sum(w * mult) as anchor, sum(w * l) as wl from cases join paths using (scenario)
  where t = 1 group by position),
-- Loans with the same inputs have the same loss per unit of balance: evaluate distinct inputs once.
units as materialized (select pd12, rate, term, stage, sum(upb) as upb from @book group by all),
steps as (select position, pd12, rate, term, stage, upb, scenario, w, l, t, horizon, wl,
    least(greatest((1 - pow(1 - pd12, 1e0 / 12)) * mult / anchor, 0e0), 1e0) as h,
    1 - pow(1 - cpr, 1e0 / 12) as smm,
    greatest((pow(1 + rate / 12e2, term) - pow(1 + rate / 12e2, least(t, term)))
      / (pow(1 + rate / 12e2, term) - 1), 0e0) * pow(1 + rate / 12e2, -t) as v
  from units join cases on stage < 3 join paths using (scenario) join anchors using (position)
  where t <= horizon and t <= case when stage = 1 then 12 else 60 end),
alive as (select *, coalesce(exp(sum(ln(1 - h) + ln(1 - smm)) over (partition by position, pd12, rate, term,
    stage, scenario order by t rows between unbounded preceding and 1 preceding)), 1e0) as s from steps),
totals as (select position, sum(e) as total_ecl from (
    select position, sum(upb * w * l * s * h * v) as e from alive group by position
    union all select position, wl * (select sum(upb) from @book where stage = 3) from anchors) group by position)
select position, round(total_ecl, 1) as total_ecl,
  round(total_ecl / (select sum(upb) from @book) * 100, 6) as coverage_pct,
  round((total_ecl / (select total_ecl from totals where position = 0) - 1) * 100, 6) as delta_vs_base_pct
from totals"""


@query("v10_sensitivity_grid", grid_sql(GRID_CASES))
def v10(spark, sf):
    cases = loss.sensitivity_cases(grid_paths(spark, sf), SCENARIOS.weights, BASE_LGD,
                                   DOWNTURN_LGD, LOSS, GRID)
    out = durable(loss.sensitivity_grid(book(spark, sf), cases))
    return out.select("position", F.round("total_ecl", 1).alias("total_ecl"),
                      F.round("coverage_pct", 6).alias("coverage_pct"),
                      F.round("delta_vs_base_pct", 6).alias("delta_vs_base_pct"))


@query("v10_sensitivity_levers", grid_sql(LEVER_CASES))
def v10_levers(spark, sf):
    """All levers of the settings."""
    cases = loss.sensitivity_cases(grid_paths(spark, sf), SCENARIOS.weights, BASE_LGD,
                                   DOWNTURN_LGD, LOSS, ValidationSettings())
    out = durable(loss.sensitivity_grid(book(spark, sf), cases))
    return out.select("position", F.round("total_ecl", 1).alias("total_ecl"),
                      F.round("coverage_pct", 6).alias("coverage_pct"),
                      F.round("delta_vs_base_pct", 6).alias("delta_vs_base_pct"))


@query("v11_traffic_light", """
select rag, count(*) as n from (select case when pd_orig <= 0 or delq_num is null then 'n/a'
  when pd_now / pd_orig >= 2 then 'RED' when pd_now / pd_orig >= 11e-1 then 'AMBER' else 'GREEN' end as rag
  from @snapshot) group by rag""")
def v11(spark, sf):
    value = F.when(F.col("delq_num").isNotNull(), F.col("pd_now") / F.col("pd_orig"))
    return snapshot(spark, sf).groupBy(
        monitoring.traffic_light(value, 1.1, 2.0).alias("rag")).agg(F.count(F.lit(1)).alias("n"))


PSI_SQL = f"""{edges_sql('@scored', 'period', 'p', 'pred_pd')},
  psis as materialized (select "from", "to", psi, case when psi is null then 'n/a' when psi >= 25e-2 then 'RED'
    when psi >= 1e-1 then 'AMBER' else 'GREEN' end as rag
  from ({psi_sql('@scored', 'period', 'p', 'pred_pd')}))"""


@query("v12_score_stability", f"""
with {PSI_SQL} select "from", "to", round(psi, 8) as psi, rag from psis""")
def v12(spark, sf):
    panel = durable(backtest_panel(spark, sf).select("period", "pred_pd"))
    return monitoring.score_stability(panel).withColumn(
        "psi", F.round("psi", 8))


LIGHTS_SQL = f"""{PSI_SQL}, lights as (select 'backtest' as source, period, rag from ({BACKTEST_SQL})
  union all select 'psi', "to", rag from psis)"""
WORST = ("case when count(*) = 0 then 'n/a' when count(case when rag = 'RED' then 1 end) > 0 then 'RED' "
         "when count(case when rag = 'AMBER' then 1 end) > 0 then 'AMBER' else 'GREEN' end")


def lights(spark, sf):
    """The panel is stored once, scored and before the cut, which needs its last month."""
    rows = scored(spark, sf, labelled(spark, sf)).withColumnRenamed("p", "pred_pd")
    panel = labels.drop_open_window(durable_columns(monitoring.with_quarter(rows).select(
        "reporting_period", "period", "pred_pd", "target")), 12)
    return monitoring.lights(monitoring.backtest(panel), monitoring.score_stability(panel))


@query("v13_status", f"""
with {LIGHTS_SQL}
select (select {WORST} from (select arg_max(rag, period) as rag from lights group by source)) as latest_status,
  {WORST} as historical_worst from lights""")
def v13(spark, sf):
    return monitoring.status(durable(lights(spark, sf)))


@query("v14_monitoring_run", f"""
with {LIGHTS_SQL}
select source, rag, count(*) as n, max(period) as last_period from lights group by source, rag""")
def v14(spark, sf):
    return lights(spark, sf).groupBy("source", "rag").agg(
        F.count(F.lit(1)).alias("n"), F.max("period").alias("last_period"))


# ---- result views --------------------------------------------------------------------------


@query("s17_overview", COVERAGE_SQL + """
select round(sum(ecl), 1) as total_ecl, round(sum(upb), -1) as total_ead, count(*) as n_loans,
  round(max(total), 6) as coverage_pct, cast(null as varchar) as monitoring_status,
  count(distinct stage) as stages from loan_ecl join cover on true""")
def s17(spark, sf):
    rows = durable(staged(spark, sf))  # one row per loan, for the losses and the counts
    stages = rows.groupBy("stage").agg(F.count(F.lit(1)).alias("n"))
    view = results.overview(spark, summary(spark, sf, rows), durable(stages))
    return view.select(
        F.round("total_ecl", 1).alias("total_ecl"), F.round("total_ead", -1).alias("total_ead"),
        "n_loans", F.round("coverage_pct", 6).alias("coverage_pct"), "monitoring_status",
        F.size("stage_distribution").cast("bigint").alias("stages"))


@query("s17_loss_view", COVERAGE_SQL + """
select round(sum(ecl_12m), 1) as ecl_12m_total, round(sum(ecl_lifetime), 1) as ecl_lifetime_total,
  count(distinct stage) as stages from loan_ecl""")
def s17_loss(spark, sf):
    view = results.loss_view(spark, summary(spark, sf))
    return view.select(F.round("ecl_12m_total", 1).alias("ecl_12m_total"),
                       F.round("ecl_lifetime_total", 1).alias("ecl_lifetime_total"),
                       F.size("by_stage").cast("bigint").alias("stages"))


@query("s17_scenario_view", f"""
with {PIT_PATHS_SQL}
select round(sum(case when month = 12 then weight * pit_pd end), 9) as weighted_pit_pd_12m,
  max(month) as horizon_months, count(*) as points from pit""")
def s17_scenario(spark, sf):
    paths = durable(pit_paths(spark, sf))
    view = results.scenario_view(spark, paths, scenarios.ordering_check(paths))
    return view.select(F.round("weighted_pit_pd_12m", 9).alias("weighted_pit_pd_12m"),
                       "horizon_months", F.size("paths").cast("bigint").alias("points"))


@query("s17_validation_view", COVERAGE_SQL + """
select cast(s1 <= s2 and s2 <= s3 as bigint) as n_error_passed, 1 as n_error_checks, 0 as n_advisory,
  1 as checks from cover""")
def s17_validation(spark, sf):
    checks = durable(validation.coverage_rises_by_stage(summary(spark, sf)))
    view = results.validation_view(spark, checks, validation.tally(checks))
    return view.select("n_error_passed", "n_error_checks", "n_advisory",
                       F.size("checks").cast("bigint").alias("checks"))


@query("s17_monitoring_view", f"""
with {LIGHTS_SQL}
select (select {WORST} from (select arg_max(rag, period) as rag from lights group by source)) as latest_status,
  {WORST} as historical_worst, count(case when rag = 'RED' then 1 end) as red,
  count(case when rag = 'GREEN' then 1 end) as green from lights""")
def s17_monitoring(spark, sf):
    rows = durable(lights(spark, sf))
    view = results.monitoring_view(spark, monitoring.status(rows), monitoring.breaches(rows))
    return view.select("latest_status", "historical_worst", "red", "green")


@query("s17_model_view", f"""
with {RANKED_SQL}
select 'formula' as pd_best_model, round(sum(bad * (good_below + good / 2)) / (max(tb) * max(tg)), 8) as pd_auc,
  (select count(*) from @losses) as lgd_n, (select round(avg(lgd), 8) from @losses) as lgd_mean from ranked""")
def s17_model(spark, sf):
    m = metrics.ranking_metrics(slices(spark, sf)).withColumn("model", F.lit("formula"))
    view = results.model_view(spark, metrics=durable(m),
                              lgd=severity.severity_statistics(losses(spark, sf)))
    return view.select("pd_best_model", F.round("pd_auc", 8).alias("pd_auc"), "lgd_n",
                       F.round("lgd_mean", 8).alias("lgd_mean"))
