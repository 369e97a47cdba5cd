"""Windows, ordering, sampling and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossloom.functions.rates import monthly_prepay_value
from lossloom.operators import (
    drift,
    labels,
    macro,
    metrics,
    quality,
    sampling,
    severity,
)
from lossloom.operators.durable import durable
from lossloom.operators.windows import by_loan, whole_loan
from workload import tables
from workload.common import (
    CELL,
    closed,
    digest,
    digest_sql,
    feat,
    labelled,
    losses,
    macro_table,
    scored,
    scratch,
)
from workload.q_cohort import book
from workload.q_data import HASH_SQL
from workload.registry import query

# ---- windows -------------------------------------------------------------------------------

for _name, _column in (
        ("w1_months_on_book", "months_on_book"), ("w3_balance_change", "balance_change_3m"),
        ("w4_delinquency_change", "delq_change_3m"), ("w5_rolling_max", "max_delq_6m"),
        ("w5_rolling_max_12", "max_delq_12m"), ("w6_rolling_count", "count_30dpd_12m"),
        ("w7_ever_late", "ever_30dpd_12m")):
    query(_name, digest_sql(_column, "@feat", *CELL))(
        lambda spark, sf, c=_column: digest(feat(spark, sf), c, *CELL))


@query("w2_running_principal", digest_sql(
    "share", "(select *, ln(cum_principal_paid) as share from @feat)", *CELL))
def w2(spark, sf):
    rows = feat(spark, sf).withColumn("share", F.ln("cum_principal_paid"))
    return digest(rows, "share", *CELL)


@query("w8_forward_max", digest_sql("ahead", """(select *,
    max(cast(coalesce(delq_num, 0) >= 3 as integer)) over (partition by loan_id
      order by reporting_period rows between 1 following and 12 following) as ahead
    from @numbered)""", *CELL))
def w8(spark, sf):
    rows = feat(spark, sf).withColumn("ahead", labels.forward_event(12, 3))
    return digest(rows, "ahead", *CELL)


@query("w9_months_left", digest_sql("months_left", """(select *,
    max(year(reporting_period) * 12 + month(reporting_period)) over (partition by loan_id)
      - (year(reporting_period) * 12 + month(reporting_period)) as months_left from @panel)""",
                                    *CELL))
def w9(spark, sf):
    rows = tables.full_panel(spark, sf).withColumn("months_left", labels.months_left())
    return digest(rows, "months_left", *CELL)


@query("w10_forward_value", digest_sql("kept", """(select *,
    lead(upb_current, 12) over (partition by loan_id order by reporting_period) / upb_orig as kept
    from @panel)""", *CELL))
def w10(spark, sf):
    rows = tables.full_panel(spark, sf).withColumn(
        "kept", F.lead("upb_current", 12).over(by_loan()) / F.col("upb_orig"))
    return digest(rows, "kept", *CELL)


@query("w11_latest_valid_row", "select loan_id, upb, rate, term from @latest")
def w11(spark, sf):
    from lossloom.operators.exposure import latest_exposure

    return latest_exposure(tables.monthly(spark, sf))


WINDOWS_SQL = """select window_start, window_end, n_obs, s / n_obs as lgd from (
  select month as window_end, cast(month - to_months(23) as date) as window_start,
    cast(sum(c) over w as bigint) as n_obs, sum(s) over w as s, count(*) over w as filled
  from (select cast(a + to_months(cast(i as integer)) as date) as month
        from (select min(date_trunc('month', default_period)) as a,
                     max(date_trunc('month', default_period)) as b from @losses)
        join (select unnest(range(0, 1200)) as i) on a + to_months(cast(i as integer)) <= b)
  left join (select cast(date_trunc('month', default_period) as date) as month, sum(lgd) as s,
               count(lgd) as c from @losses group by 1) using (month)
  window w as (order by month rows between 23 preceding and current row)) where filled = 24"""


@query("w12_rolling_windows", f"""
select window_start, window_end, n_obs, round(lgd, 8) as lgd from ({WINDOWS_SQL})""")
def w12(spark, sf):
    return severity.rolling_windows(losses(spark, sf)).withColumn("lgd", F.round("lgd", 8))


@query("w13_score_shares", """
select p, cast(sum(bad) over (order by p) as double) / sum(bad) over () as cum_bad,
  cast(sum(good) over (order by p) as double) / sum(good) over () as cum_good
from (select p, sum(target) as bad, sum(1 - target) as good from @scored group by p)""")
def w13(spark, sf):
    from lossloom.operators import ranks

    sliced = metrics.score_counts(scored(spark, sf), "target", "p")
    r = ranks.running_totals(sliced, [], "p", ["bad", "good"])
    return r.select("p", ((F.col("bad_before") + F.col("bad")) / F.col("bad_total"))
                    .alias("cum_bad"),
                    ((F.col("good_before") + F.col("good")) / F.col("good_total"))
                    .alias("cum_good"))


@query("w14_year_on_year", """
select reporting_period, round(hpi_yoy, 6) as hpi_yoy, round(gdp_yoy, 6) as gdp_yoy from @macro""")
def w14(spark, sf):
    return macro_table(spark, sf).select(
        "reporting_period", F.round("hpi_yoy", 6).alias("hpi_yoy"),
        F.round("gdp_yoy", 6).alias("gdp_yoy"))


@query("w15_forward_fill", """
select reporting_period, round(real_gdp, 6) as real_gdp from @macro""")
def w15(spark, sf):
    return macro_table(spark, sf).select("reporting_period",
                                         F.round("real_gdp", 6).alias("real_gdp"))


@query("w16_latest_value", """
select round(arg_max(unemployment, reporting_period), 8) as unemployment,
  round(arg_max(hpi_yoy, reporting_period), 8) as hpi_yoy,
  round(arg_max(early, reporting_period) filter (where early is not null), 8) as early
from (select *, case when reporting_period < date '2000-01-01' then hpi end as early from @macro)""")
def w16(spark, sf):
    table = macro_table(spark, sf).withColumn(
        "early", F.when(F.col("reporting_period") < F.lit("2000-01-01").cast("date"), F.col("hpi")))
    latest = macro.latest_values(table, ["unemployment", "hpi_yoy", "early"])
    return latest.select(*[F.round(c, 8).alias(c) for c in latest.columns])


@query("w17_survival", """
select stage, count(*) as n, round(avg(pow(1 - h, 60) * pow(1 - smm, 60)), 8) as survival
from (select stage, 1 - pow(1 - least(greatest(pd12, 0e0), 999999e-6), 1e0 / 12) as h,
        1 - pow(1 - 1e-1, 1e0 / 12) as smm from @book) group by stage""")
def w17(spark, sf):
    from lossloom.functions.rates import monthly_hazard

    smm = monthly_prepay_value(0.10)
    alive = F.pow(1 - monthly_hazard("pd12"), F.lit(60.0)) * F.pow(F.lit(1 - smm), F.lit(60.0))
    return book(spark, sf).groupBy("stage").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(alive), 8).alias("survival"))


# ---- ordering, limits, samples -------------------------------------------------------------


@query("t1_window_order", """
select loan_id, min(reporting_period) as first_month, max(reporting_period) as last_month,
  count(*) as n from @panel group by loan_id""")
def t1(spark, sf):
    rows = tables.monthly(spark, sf).withColumns({
        "first_month": F.min("reporting_period").over(whole_loan()),
        "last_month": F.max("reporting_period").over(whole_loan()),
        "n": F.count(F.lit(1)).over(whole_loan()),
        "rn": F.row_number().over(by_loan())})
    return rows.filter("rn = 1").select("loan_id", "first_month", "last_month", "n")


@query("t2_ordered_results", """
select reporting_period, count(*) as n from @panel group by 1 order by 1""")
def t2(spark, sf):
    return tables.monthly(spark, sf).groupBy("reporting_period").agg(
        F.count(F.lit(1)).alias("n")).orderBy("reporting_period")


@query("t3_last_periods", """
select reporting_period, avg(target) as dr, count(*) as n from @closed group by 1
having count(*) >= 500 order by reporting_period desc limit 18""")
def t3(spark, sf):
    return labels.default_rate_by_period(closed(spark, sf)).orderBy(
        F.desc("reporting_period")).limit(18)


@query("t4_worst_window", f"""
select window_start, window_end, n_obs, round(lgd, 8) as lgd from ({WINDOWS_SQL})
where n_obs >= 100 order by lgd desc, window_end limit 1""")
def t4(spark, sf):
    return severity.worst_window(losses(spark, sf)).withColumn("lgd", F.round("lgd", 8))


@query("t5_status_order", """
select status, n from (values ('PASS', 4), ('FAIL', 1), ('WARN', 2), ('INFO', 3)) o(status, pos)
join (select case when delq_num >= 3 then 'FAIL' when delq_num >= 1 then 'WARN' when delq_num is null
  then 'INFO' else 'PASS' end as status, count(*) as n from @feat group by 1) using (status)
order by pos""")
def t5(spark, sf):
    late = F.col("delq_num")
    status = F.when(late >= 3, "FAIL").when(late >= 1, "WARN").when(late.isNull(), "INFO")
    rows = feat(spark, sf).groupBy(status.otherwise("PASS").alias("status")).agg(
        F.count(F.lit(1)).alias("n"))
    rows = rows.withColumns({c: F.lit("") for c in ("table", "check_type", "column", "metric")})
    return quality.by_severity(rows).select("status", "n")


KEY = ("loan_id", "reporting_period")
ROW_HASH = ("md5(concat(cast(loan_id as varchar), '|', cast(reporting_period as varchar), '#42'))")
TIE = "md5(concat(cast(loan_id as varchar), '|', cast(reporting_period as varchar)))"
MAX_ROWS = 60_000


def sample_sql(take: str) -> str:
    return f"""select target, count(*) as n, cast(sum(loan_id) as bigint) as loans,
  cast(sum(months_on_book) as bigint) as months from (
  select *, row_number() over (partition by target order by {HASH_SQL.replace("md5(cast(loan_id as varchar))", ROW_HASH)},
      {TIE}) as rn, count(*) over (partition by target) as size, count(*) over () as all_rows,
      count(case when target = 1 then 1 end) over () as pos from @labelled)
  where rn <= {take} group by target"""


def sampled_rows(spark, sf):
    """Stored narrow: the cut counts the rows before it picks, and reads them four times."""
    return durable(labelled(spark, sf).select(*KEY, "target", "months_on_book"))


def sample_digest(df):
    return df.groupBy("target").agg(
        F.count(F.lit(1)).alias("n"), F.sum("loan_id").alias("loans"),
        F.sum("months_on_book").alias("months"))


@query("t6_keep_rare_class", sample_sql(
    f"case when target = 1 or all_rows <= {MAX_ROWS} then size "
    f"else greatest({MAX_ROWS} - pos, 1000) end"))
def t6(spark, sf):
    return sample_digest(sampling.keep_rare_class(
        sampled_rows(spark, sf), MAX_ROWS, sampling.row_key(*KEY), 42))


@query("t7_keep_class_rates", sample_sql(
    f"floor(size * least(1e0, {MAX_ROWS}e0 / all_rows))"))
def t7(spark, sf):
    return sample_digest(sampling.keep_class_rates(
        sampled_rows(spark, sf), MAX_ROWS, sampling.row_key(*KEY), 42))


CURVE_SQL = """steps as (select p, cast(sum(bad) over d as double) as tps, cast(sum(good) over d as double) as fps,
    bad, good, sum(bad) over () as all_bad, sum(good) over () as all_good,
    lead(bad) over d as next_bad, lead(good) over d as next_good, lag(p) over d as higher
  from (select p, sum(target) as bad, sum(1 - target) as good from @scored group by p)
  window d as (order by p desc)),
kept as (select *, row_number() over (order by p desc) as position, count(*) over () + 1 as size
  from steps where next_bad is null or higher is null or bad <> next_bad or good <> next_good),
curve as (select position, size, fps / all_good as fpr, tps / all_bad as tpr from kept
  union all select distinct 0, size, 0e0, 0e0 from kept)"""


@query("t8_even_points", f"""
with {CURVE_SQL}
select position, fpr, tpr from curve where size <= 60 or position in
  (select cast(round_even(i * (size - 1) / 59e0, 0) as bigint)
   from (select distinct size from kept) join (select unnest(range(0, 60)) as i) on true)""")
def t8(spark, sf):
    return metrics.roc_points(metrics.score_counts(scored(spark, sf), "target", "p"))


# ---- set operations ------------------------------------------------------------------------


@query("u1_union_all", """
select vintage, count(*) as n, count(note) as noted, cast(sum(age) as double) as age from (
  select vintage, loan_age as age, null as note from @panel where vintage < '1998'
  union all select vintage, cast(loan_age as bigint), 'late' from @panel where vintage >= '1998')
group by vintage""")
def u1(spark, sf):
    rows = tables.monthly(spark, sf)
    early = rows.filter(F.col("vintage") < "1998").select("vintage", F.col("loan_age").alias("age"))
    late = rows.filter(F.col("vintage") >= "1998").select(
        "vintage", F.col("loan_age").cast("bigint").alias("age"), F.lit("late").alias("note"))
    both = early.unionByName(late, allowMissingColumns=True)
    return both.groupBy("vintage").agg(F.count(F.lit(1)).alias("n"), F.count("note").alias("noted"),
                                       F.sum("age").alias("age"))


@query("u1_files_of_different_types", """
select vintage, count(*) as n, count(age) as known, cast(sum(age) as double) as age,
  round(sum(upb), 1) as upb, count(note) as noted
from (select vintage, case when substr(vintage, 6, 1) <> '4' then loan_age end as age,
    upb_current as upb, case when substr(vintage, 6, 1) = '2' then 'x' end as note from @panel)
group by vintage""")
def u1_files(spark, sf):
    """Quarters written with whole, fractional and missing ages, other balances and a further column."""
    from lossloom.sources.united import read_united

    root, rows = scratch(spark), tables.monthly(spark, sf)
    age, upb, q = F.col("loan_age"), F.col("upb_current"), F.substring("vintage", 6, 1)
    forms = {"1": [age.cast("int").alias("age"), upb.alias("upb")],
             "2": [age.alias("age"), upb.alias("upb"), F.lit("x").alias("note")],
             "3": [upb.alias("upb"), age.cast("bigint").alias("age")], "4": [upb.alias("upb")]}
    paths = []
    for k, columns in forms.items():
        part = rows.filter(q == k)
        part.select(F.col("vintage").alias("quarter"), "vintage", *columns).write.partitionBy(
            "quarter").parquet(f"{root}/{k}")
        paths += [f"{root}/{k}/quarter={r['vintage']}" for r in part.select("vintage").distinct().collect()]
    return read_united(spark, paths).groupBy("vintage").agg(
        F.count(F.lit(1)).alias("n"), F.count("age").alias("known"), F.sum("age").alias("age"),
        F.round(F.sum("upb"), 1).alias("upb"), F.count("note").alias("noted"))


@query("u2_class_union", """
select target, count(*) as n from @labelled group by target""")
def u2(spark, sf):
    rows = labelled(spark, sf)
    both = rows.filter("target = 1").unionByName(rows.filter("target = 0"))
    return both.groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@query("u3_distinct_keys", """
select cast((select count(*) from @panel) - count(*) as double) as value from
  (select distinct loan_id, loan_age from @panel)""")
def u3(spark, sf):
    return quality.duplicate_check(tables.monthly(spark, sf), "loan_monthly",
                                   ["loan_id", "loan_age"]).select("value")


@query("u4_distinct_vintages", "select distinct vintage from @panel")
def u4(spark, sf):
    return tables.monthly(spark, sf).select("vintage").distinct()


@query("u5_column_difference", """
select 'missing_columns' as metric, 1e0 as value, 'FAIL' as status, count(*) as n from @panel
union all select 'extra_columns', 9e0, 'WARN', count(*) from @panel""")
def u5(spark, sf):
    monthly = tables.monthly(spark, sf)
    rows = quality.Checks("loan_monthly").schema(monthly, ["loan_id", "servicer_name"])
    n = monthly.agg(F.count(F.lit(1)).alias("n")).scalar()
    return rows.run(monthly).select("metric", "value", "status").withColumn("n", n)


QUARTERS = ("1996Q2", "2000Q3", "2001Q1", "2001Q2")


@query("u6_missing_quarters", f"""
with p as (select distinct cast(substr(vintage, 1, 4) as bigint) * 4
    + cast(substr(vintage, 6, 1) as bigint) - 1 as q from @loans
  where vintage like '20%' and vintage not in {QUARTERS})
select concat(cast(q // 4 as varchar), 'Q', cast(q % 4 + 1 as varchar)) as vintage
from (select unnest(range(8000, 8100)) as q)
where q not in (select q from p) and q between (select min(q) from p) and (select max(q) from p)""")
def u6(spark, sf):
    return drift.missing_quarters(
        tables.master(spark, sf).filter(~F.col("vintage").isin(*QUARTERS)))
