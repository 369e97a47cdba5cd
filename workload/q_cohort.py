"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossloom.operators import (
    cohorts,
    drift,
    features,
    labels,
    loss,
    monitoring,
    quality,
    severity,
    staging,
)
from lossloom.sources import raw_files
from lossloom.params import EventCodes
from workload import sql, tables
from workload.common import (
    BASE_LGD,
    DOWNTURN_LGD,
    LOSS,
    SCENARIOS,
    SCORE_COLUMNS,
    book,
    closed,
    feat,
    lgd,
    long_run_rate,
    losses,
    scored,
    scratch,
    staged,
)
from workload.registry import query

AGES = list(range(EventCodes().max_age + 1))


@query("a1_delinquency_timeseries", """
select reporting_period, count(*) as active, count(case when delq_num >= 1 then 1 end) as dpd30,
  count(case when delq_num >= 3 then 1 end) as dpd90 from @numbered group by 1""")
def a1(spark, sf):
    return cohorts.delinquency_by_period(tables.monthly(spark, sf))


OUTCOMES_SQL = f"""select vintage, count(distinct loan_id) as loans,
  count(distinct case when zero_balance_code in ({sql.CODES}) then loan_id end) as defaults,
  count(distinct case when zero_balance_code = '01' then loan_id end) as prepaid
  from @panel group by vintage"""


@query("a2_vintage_outcomes", OUTCOMES_SQL)
def a2(spark, sf):
    return cohorts.outcomes_by_vintage(tables.monthly(spark, sf))


@query("a3_seasoning_curve", """
select cast(loan_age as integer) as loan_age, count(*) as n,
  count(case when delq_num >= 3 then 1 end) as dpd90 from @numbered
where loan_age between 0 and 60 group by 1""")
def a3(spark, sf):
    return cohorts.seasoning_curve(tables.monthly(spark, sf))


MATRIX_SQL = """select vintage, cast(loan_age as integer) as age, count(*) as n,
  count(case when delq_num >= 3 then 1 end) as dpd90 from @numbered
  where loan_age between 0 and 60 group by 1, 2"""


@query("a4_cohort_matrix", MATRIX_SQL)
def a4(spark, sf):
    return cohorts.cohort_matrix(tables.monthly(spark, sf))


@query("a5_cohort_pivot", f"""
select vintage, {', '.join(f"max(case when age = {a} then 1e2 * dpd90 / n end) as age_{a}"
                           for a in AGES)}
from ({MATRIX_SQL}) group by vintage""")
def a5(spark, sf):
    return cohorts.cohort_pivot(cohorts.cohort_matrix(tables.monthly(spark, sf)), AGES)


@query("a6_outcome_rates", f"""
select vintage, loans, defaults, prepaid, 1e2 * defaults / loans as default_rate,
  1e2 * prepaid / loans as prepay_rate from ({OUTCOMES_SQL})""")
def a6(spark, sf):
    return cohorts.percent(cohorts.outcomes_by_vintage(tables.monthly(spark, sf)), "loans",
                           default_rate="defaults", prepay_rate="prepaid")


@query("a6_delinquency_rates", """
select reporting_period, 1e2 * dpd30 / active as dpd30_rate, 1e2 * dpd90 / active as dpd90_rate
from (select reporting_period, count(*) as active, count(case when delq_num >= 1 then 1 end) as dpd30,
  count(case when delq_num >= 3 then 1 end) as dpd90 from @numbered group by 1)""")
def a6_rates(spark, sf):
    return cohorts.percent(cohorts.delinquency_by_period(tables.monthly(spark, sf)), "active",
                           dpd30_rate="dpd30", dpd90_rate="dpd90").select(
        "reporting_period", "dpd30_rate", "dpd90_rate")


@query("a7_loans_by_state", "select state, count(*) as loans from @loans group by state")
def a7(spark, sf):
    return cohorts.loans_by_state(tables.master(spark, sf))


HISTOGRAM = ["fico_orig", "ltv_orig", "dti_orig", "upb_orig", "int_rate_orig"]


@query("a8_histograms", " union all ".join(f"""
select '{c}' as feature, bin, lo + (hi - lo) / 50 * bin as lo, lo + (hi - lo) / 50 * (bin + 1) as hi, n
from (select bin, lo, hi, count(*) as n from (
  select lo, hi, cast(least(floor(({c} - lo) * 50 / (hi - lo)), 49) as integer) as bin
  from @loans join (select min({c}) as lo, max({c}) as hi from @loans) on true)
  group by bin, lo, hi)""" for c in HISTOGRAM))
def a8(spark, sf):
    return cohorts.histograms(tables.master(spark, sf), HISTOGRAM)


@query("a9_vintage_statistics", "select * from @vstats")
def a9(spark, sf):
    return features.vintage_statistics(tables.master(spark, sf))


@query("a10_terminal_events", "select * from @terminal")
def a10(spark, sf):
    return labels.terminal_events(tables.monthly(spark, sf))


@query("a11_default_rate_by_period", """
select reporting_period, avg(target) as dr, count(*) as n from @closed group by 1
having count(*) >= 500""")
def a11(spark, sf):
    return labels.default_rate_by_period(closed(spark, sf))


@query("a12_long_run_rate", "select avg(target) as ttc_pd from @closed")
def a12(spark, sf):
    return long_run_rate(spark, sf).withColumnRenamed("target", "ttc_pd")


@query("a13_first_row_per_loan", """
select loan_id, upb_orig, fico_orig, state, vintage from (
  select *, row_number() over (partition by loan_id order by reporting_period) as rn from @panel)
where rn = 1""")
def a13(spark, sf):
    return raw_files.master_rows(tables.full_panel(spark, sf)).select(
        "loan_id", "upb_orig", "fico_orig", "state", "vintage")


def ends(spark, sf):
    return staging.first_and_current_rows(feat(spark, sf), [*SCORE_COLUMNS, "loan_age"])


@query("a14_origination_row", """
select loan_id, loan_age, current_ltv, delq_num from (
  select *, row_number() over (partition by loan_id order by loan_age, reporting_period) as rn
  from @feat) where rn = 1""")
def a14(spark, sf):
    return ends(spark, sf).select("loan_id", "first.loan_age", "first.current_ltv",
                                  "first.delq_num")


@query("a15_current_row", """
select loan_id, reporting_period, current_ltv, delq_num, count_30dpd_12m from (
  select *, row_number() over (partition by loan_id order by reporting_period desc) as rn
  from @feat) where rn = 1""")
def a15(spark, sf):
    return ends(spark, sf).select("loan_id", "current.reporting_period", "current.current_ltv",
                                  "current.delq_num", "current.count_30dpd_12m")


@query("a16_stage_distribution", """
select stage, count(*) as n, round(count(*) / (select count(*) from @staged) * 100, 2) as pct
from @staged group by stage""")
def a16(spark, sf):
    return staging.stage_distribution(staged(spark, sf))


@query("a17_migration_counts", """
select a.stage as stage_from, least(3, a.stage + cast(a.loan_id % 5 = 0 as integer)) as stage_to,
  count(*) as n from @staged a group by 1, 2""")
def a17(spark, sf):
    before = staged(spark, sf).select("loan_id", "stage")
    after = before.withColumn("stage", F.least(
        F.lit(3), F.col("stage") + (F.col("loan_id") % 5 == 0).cast("int")))
    return staging.migration_matrix(before, after)


@query("a18_trigger_counts", """
select count(case when is_default then 1 end) as default_90dpd,
  count(case when sicr_backstop_30dpd then 1 end) as backstop_30dpd,
  count(case when sicr_pd_deterioration then 1 end) as pd_deterioration from @staged""")
def a18(spark, sf):
    return staging.trigger_counts(staged(spark, sf))


def flat_case(spark, sf, rows=None):
    """Scenario paths that depend on the data through the long-run rate only.

    ``rows`` are the closed labelled rows, if the caller has them.
    """
    ttc = (long_run_rate(spark, sf) if rows is None else rows.agg(F.avg("target"))).first()[0]
    horizon = SCENARIOS.horizon
    paths = {"base": tuple(ttc * (1 + t / 200) for t in range(1, horizon + 1)),
             "upside": tuple(ttc * (0.8 - t / 400) for t in range(1, horizon + 1)),
             "downside": tuple(ttc * (1.5 + t / 40) for t in range(1, horizon + 1))}
    return loss.loss_case("book", paths, SCENARIOS.weights, BASE_LGD, DOWNTURN_LGD, LOSS)


# The same case in SQL: one row per loan, scenario and month; survival as a running product.
PATH_SQL = f"""select s.scenario, s.weight, s.lgd, t, p / anchor as mult from (
    select scenario, weight, lgd, t, ttc * (a + t / b) as p, ttc,
      ttc * (5e-1 * (1 + 1 / 2e2) + 25e-2 * (8e-1 - 1 / 4e2) + 25e-2 * (15e-1 + 1 / 4e1)) as anchor
    from (select avg(target) as ttc from @closed)
    join (values ('base', 5e-1, {BASE_LGD}e0, 1e0, 2e2), ('upside', 25e-2, {BASE_LGD}e0, 8e-1, -4e2),
                 ('downside', 25e-2, {DOWNTURN_LGD}e0, 15e-1, 4e1)) v(scenario, weight, lgd, a, b)
      on true
    join (select unnest(range(1, 61)) as t) on true) s"""

LOSS_SQL = f"""
paths as materialized ({PATH_SQL}),
inputs as materialized (select *, 1 - pow(1 - least(greatest(pd12, 0e0), 999999e-6), 1e0 / 12) as h0,
    rate / 1e2 / 12e0 as r, 1 - pow(1 - 1e-1, 1e0 / 12) as smm from @book),
steps as materialized (
  select loan_id, stage, upb, scenario, weight, lgd, t, least(greatest(h0 * mult, 0e0), 1e0) as h, smm,
    greatest(upb * (pow(1 + r, term) - pow(1 + r, least(t, term))) / (pow(1 + r, term) - 1), 0e0)
      * pow(1 + r, -t) as v
  from inputs join paths on true),
alive as (select *, coalesce(exp(sum(ln(1 - h) + ln(1 - smm)) over (partition by loan_id, scenario
    order by t rows between unbounded preceding and 1 preceding)), 1e0) as s from steps),
per_loan as materialized (
  select loan_id, stage, upb,
    case when stage >= 3 then (75e-2 * {BASE_LGD}e0 + 25e-2 * {DOWNTURN_LGD}e0) * upb
      else sum(case when t <= 12 then weight * s * h * lgd * v end) end as ecl_12m,
    case when stage >= 3 then (75e-2 * {BASE_LGD}e0 + 25e-2 * {DOWNTURN_LGD}e0) * upb
      else sum(weight * s * h * lgd * v) end as ecl_lifetime
  from alive group by loan_id, stage, upb),
loan_ecl as (select *, case when stage = 1 then ecl_12m else ecl_lifetime end as ecl from per_loan)"""


@query("a19_loss_summary", f"""
with {LOSS_SQL}
select stage, count(*) as n_loans, round(sum(upb), -1) as ead, round(sum(ecl), 1) as ecl,
  round(sum(ecl_12m), 1) as ecl_12m, round(sum(ecl_lifetime), 1) as ecl_lifetime,
  round(sum(ecl) / greatest(sum(upb), 1) * 100, 6) as coverage_pct,
  count(case when ecl is null then 1 end) as n_without_loss,
  coalesce(round(sum(case when ecl is null then upb end), -1), 0e0) as ead_without_loss
from loan_ecl group by rollup (stage)""")
def a19(spark, sf):
    losses_per_loan = loss.loan_losses(book(spark, sf), flat_case(spark, sf))
    return loss.loss_summary(losses_per_loan).select(
        "stage", "n_loans", F.round("ead", -1).alias("ead"), F.round("ecl", 1).alias("ecl"),
        F.round("ecl_12m", 1).alias("ecl_12m"),
        F.round("ecl_lifetime", 1).alias("ecl_lifetime"),
        F.round("coverage_pct", 6).alias("coverage_pct"), "n_without_loss",
        F.round("ead_without_loss", -1).alias("ead_without_loss"))


@query("a20_severity_statistics", """
select count(*) as n, round(avg(lgd), 8) as mean, round(median(lgd), 8) as median,
  round(stddev_pop(lgd), 8) as std, round(quantile_cont(lgd, 0.1), 8) as p10,
  round(quantile_cont(lgd, 0.9), 8) as p90 from @losses""")
def a20(spark, sf):
    stats = severity.severity_statistics(losses(spark, sf))
    return stats.select("n", *[F.round(c, 8).alias(c)
                               for c in ("mean", "median", "std", "p10", "p90")])


@query("a21_severity_by_bucket", """
select case when mtm_ltv < 60 then '0-60' when mtm_ltv < 70 then '60-70' when mtm_ltv < 80 then '70-80'
    when mtm_ltv < 90 then '80-90' when mtm_ltv < 100 then '90-100' when mtm_ltv < 110 then '100-110'
    else '110-999' end as ltv_bucket, count(*) as n, round(avg(lgd), 8) as mean_lgd
from @lgd where mtm_ltv >= 0 and mtm_ltv < 999 group by 1""")
def a21(spark, sf):
    rows = severity.severity_by_bucket(lgd(spark, sf))
    return rows.withColumn("mean_lgd", F.round("mean_lgd", 8))


@query("a22_delinquency_share", """
select cast(date_trunc('quarter', reporting_period) as date) as period, count(*) as n,
  avg(case when delq_num is not null then cast(delq_num >= 1 as integer) end) as share_30dpd,
  avg(case when delq_num is not null then cast(delq_num >= 3 as integer) end) as share_90dpd
from @feat group by 1""")
def a22(spark, sf):
    return monitoring.delinquency_trend(monitoring.delinquency_panel(feat(spark, sf)))


BACKTEST_SQL = """select period, n, mean_pred_pd, realised_dr,
    mean_pred_pd / greatest(realised_dr, 1e-6) as pred_over_realised,
    case when abs(mean_pred_pd / greatest(realised_dr, 1e-6) - 1) >= 1 then 'RED'
         when abs(mean_pred_pd / greatest(realised_dr, 1e-6) - 1) >= 5e-1 then 'AMBER'
         else 'GREEN' end as rag
  from (select period, count(*) as n, avg(p) as mean_pred_pd, avg(target) as realised_dr
        from @scored group by period having count(*) >= 500)"""


def backtest_panel(spark, sf):
    return monitoring.with_quarter(scored(spark, sf).withColumnRenamed("p", "pred_pd"))


@query("a23_backtest", f"""
select period, n, round(mean_pred_pd, 8) as mean_pred_pd, realised_dr,
  round(pred_over_realised, 8) as pred_over_realised, rag from ({BACKTEST_SQL})""")
def a23(spark, sf):
    return monitoring.backtest(backtest_panel(spark, sf)).withColumns({
        "mean_pred_pd": F.round("mean_pred_pd", 8),
        "pred_over_realised": F.round("pred_over_realised", 8)})


@query("a24_breach_summary", f"""
select count(case when rag = 'RED' then 1 end) as red, count(case when rag = 'AMBER' then 1 end) as amber,
  count(case when rag = 'GREEN' then 1 end) as green from ({BACKTEST_SQL})""")
def a24(spark, sf):
    rows = monitoring.backtest(backtest_panel(spark, sf))
    return monitoring.breaches(rows.select(F.lit("backtest").alias("source"), "period", "rag"))


def check_rows(spark, sf):
    master, monthly = tables.master(spark, sf), tables.monthly(spark, sf)
    return (quality.Checks("loan_master").completeness(master, ("loan_id", "cltv_orig"), 5.0)
            .ranges(master, {"fico_orig": (650, 800), "ltv_orig": (1, 200)}).run(master)
            .unionByName(quality.Checks("loan_monthly")
                         .completeness(monthly, ("loan_id", "total_principal_current"), 5.0)
                         .dates(monthly, {"reporting_period": ("2000-01-01", "2027-01-01")})
                         .run(monthly))
            .unionByName(drift.coverage_check(master)))


@query("a25_scorecard", """
with r as (
  select 'loan_master' as t, 'PASS' as s from @loans where loan_id is null having count(*) = 0
  union all select 'loan_master', 'FAIL'
  union all select 'loan_master', 'INFO'
  union all select 'loan_master', case when count(case when fico_orig < 650 or fico_orig > 800 then 1 end) > 0
    then 'WARN' else 'PASS' end from @loans
  union all select 'loan_master', case when count(case when ltv_orig < 1 or ltv_orig > 200 then 1 end) > 0
    then 'WARN' else 'PASS' end from @loans
  union all select 'loan_master', 'PASS' from @loans having count(distinct vintage) = 27
  union all select 'loan_monthly', 'PASS' from @panel where loan_id is null having count(*) = 0
  union all select 'loan_monthly', case when 1e2 * count(case when total_principal_current is null then 1 end)
    / count(*) > 5 then 'FAIL' else 'PASS' end from @panel
  union all select 'loan_monthly', 'INFO'
  union all select 'loan_monthly', case when count(case when reporting_period < date '2000-01-01' then 1 end) > 0
    then 'WARN' else 'PASS' end from @panel)
select *, case when score >= 90 then 'A' when score >= 80 then 'B' when score >= 70 then 'C'
    when score >= 60 then 'D' else 'F' end as grade
from (select t as "table", n_pass, n_warn, n_fail, n_info, is_overall, total_checks,
    round(1e2 * (n_pass + 5e-1 * n_warn) / (n_pass + n_warn + n_fail), 1) as score
  from (select t, grouping(t) as is_overall, count(*) as total_checks,
      count(case when s = 'PASS' then 1 end) as n_pass, count(case when s = 'WARN' then 1 end) as n_warn,
      count(case when s = 'FAIL' then 1 end) as n_fail, count(case when s = 'INFO' then 1 end) as n_info
    from r group by rollup (t)))""")
def a25(spark, sf):
    return quality.scorecard(check_rows(spark, sf))


# ---- approximate statistics of quarters ----------------------------------------------------

SKETCHED = ("fico_orig", "upb_orig", "ltv_orig")
LEVELS = (0.05, 0.25, 0.5, 0.75, 0.95)


@query("a9_sketched_statistics", """
with own as (select * from @loans where vintage between '1996Q2' and '1999Q3')
select feature, level, count(*) as n, true as near_rank, true as near_loans
from own, (select unnest(['fico_orig', 'upb_orig', 'ltv_orig']) as feature),
  (select unnest([5e-2, 25e-2, 5e-1, 75e-2, 95e-2]) as level) group by feature, level""")
def a9_sketched(spark, sf):
    """Quantiles and loans of a range of quarters, one of which came later, within their stated errors."""
    from lossloom.operators import sketches
    from lossloom.sources.versions import VersionedWarehouse

    store, loans = VersionedWarehouse(spark, scratch(spark)), tables.loans(spark, sf)
    late = F.col("vintage") == "1998Q1"
    for part in (loans.filter(~late), loans.filter(late)):
        sketches.add_quarters(store, part, list(SKETCHED))
    first, last = "1996Q2", "1999Q3"
    own = loans.filter(F.col("vintage").between(first, last))
    found = None
    for f in SKETCHED:
        one = sketches.quantiles(store, f, list(LEVELS), first, last)
        found = one if found is None else found.unionByName(one)
    table = found.collect()  # a row per feature and level
    shares = own.agg(F.count(F.lit(1)).alias("n"), *[
        F.struct(F.lit(r["feature"]).alias("feature"), F.lit(r["probability"]).alias("probability"),
                 F.avg((F.col(r["feature"]) < r["value"]).cast("double")).alias("low"),
                 F.avg((F.col(r["feature"]) <= r["value"]).cast("double")).alias("high")).alias(f"r{i}")
        for i, r in enumerate(table)])
    ranks = shares.select("n", F.explode(F.array(*[f"r{i}" for i in range(len(table))])).alias("r")).select(
        "n", "r.*")
    e, p = F.lit(sketches.RANK_ERROR), F.col("probability")
    estimate = sketches.counts(store, first, last).select("n_loans").scalar()
    loans_exact = own.agg(F.count_distinct("loan_id")).scalar()
    return ranks.select("feature", p.alias("level"), "n",
                        ((F.col("low") - e <= p) & (p <= F.col("high") + e)).alias("near_rank"),
                        (F.abs(estimate / loans_exact - 1) < 4 * sketches.LOAN_ERROR).alias("near_loans"))
