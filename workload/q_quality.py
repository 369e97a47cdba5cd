"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossloom import schema
from lossloom.operators import drift, quality
from lossloom.params import QualityLimits
from workload import tables
from workload.registry import query

LIMITS = QualityLimits()


def figures(rows):
    """Everything but the message text and the check's own threshold."""
    return rows.select("check_type", "column", "metric", "value", "status")


def share_sql(kind, column, metric, source, bad, status):
    return (f"select '{kind}' as check_type, '{column}' as \"column\", '{metric}' as metric, "
            f"round(1e2 * count(case when {bad} then 1 end) / count(*), 4) as value, "
            f"{status} as status from {source}")


def null_sql(column, source):
    return share_sql("completeness", column, "null_pct", source, f"{column} is null",
                     f"case when 1e2 * count(case when {column} is null then 1 end) / count(*) > 5 "
                     "then 'FAIL' else 'PASS' end")


CORE = ["loan_id", "reporting_period", "zero_balance_code", "total_principal_current"]


@query("q1_completeness", " union all ".join(
    [null_sql(c, "@panel") for c in CORE] + [
        "select 'completeness', 'servicer_name', 'exists', 0e0, 'FAIL'",
        "select 'completeness', null, 'sparse_columns', 1e0, 'INFO'"]))
def q1(spark, sf):
    rows = tables.monthly(spark, sf)
    return figures(quality.Checks("loan_monthly").completeness(
        rows, (*CORE, "servicer_name"), 5.0).run(rows))


@query("q2_uniqueness", """
select 'uniqueness' as check_type, 'loan_id+loan_age' as "column", 'duplicate_rows' as metric,
  cast(count(*) - count(distinct (loan_id, loan_age)) as double) as value, 'PASS' as status from @panel
union all select 'uniqueness', 'l_orderkey+l_linenumber', 'duplicate_rows',
  cast(count(*) - count(distinct (l_orderkey, l_linenumber)) as double), 'FAIL' from lineitem""")
def q2(spark, sf):
    a = quality.duplicate_check(tables.monthly(spark, sf), "loan_monthly", ["loan_id", "loan_age"])
    b = quality.duplicate_check(tables.read(spark, sf, "lineitem"), "lineitem",
                                ["l_orderkey", "l_linenumber"])
    return figures(a.unionByName(b))


@query("q3_non_negative", """
select 'non_negative' as check_type, 'c_acctbal' as "column", 'negative_count' as metric,
  cast(count(case when c_acctbal < 0 then 1 end) as double) as value,
  case when count(case when c_acctbal < 0 then 1 end) > 0 then 'FAIL' else 'PASS' end as status
from customer""")
def q3(spark, sf):
    rows = tables.read(spark, sf, "customer")
    return figures(quality.Checks("customer").non_negative(rows, ("c_acctbal",)).run(rows))


@query("q4_numeric_ranges", share_sql(
    "range", "fico_orig", "out_of_range_pct", "@loans", "fico_orig < 650 or fico_orig > 800",
    "'WARN'") + " union all " + share_sql(
    "range", "ltv_orig", "out_of_range_pct", "@loans", "ltv_orig < 1 or ltv_orig > 200", "'PASS'"))
def q4(spark, sf):
    rows = tables.master(spark, sf)
    return figures(quality.Checks("loan_master").ranges(
        rows, {"fico_orig": (650, 800), "ltv_orig": (1, 200)}).run(rows))


@query("q5_date_validity", share_sql(
    "date_validity", "reporting_period", "invalid_date_pct", "@panel",
    "reporting_period is null or reporting_period < date '2000-01-01' "
    "or reporting_period > date '2004-01-01'", "'WARN'"))
def q5(spark, sf):
    rows = tables.monthly(spark, sf)
    return figures(quality.Checks("loan_monthly").dates(
        rows, {"reporting_period": ("2000-01-01", "2004-01-01")}).run(rows))


OUTLIERS = ["fico_orig", "upb_orig", "c_acctbal", "skewed"]


def outlier_rows(spark, sf):
    skew = F.pow(F.col("upb_orig") / 50000, F.lit(3.0))
    return tables.loans(spark, sf).withColumn("skewed", skew).withColumn(
        "dti_orig", F.lit(None).cast("double"))


@query("q6_outliers", " union all ".join(f"""
select 'outlier' as check_type, '{c}' as "column", 'outlier_pct' as metric, 'INFO' as status,
  round(1e2 * count(case when x < q1 - 15e-1 * (q3 - q1) or x > q3 + 15e-1 * (q3 - q1) then 1 end)
    / count(*), 4) as value
from (select {e} as x from @loans), (select quantile_cont({e}, 0.25) as q1,
  quantile_cont({e}, 0.75) as q3 from @loans)""" for c, e in (
    ("fico_orig", "fico_orig"), ("upb_orig", "upb_orig"), ("skewed", "pow(upb_orig / 50000, 3e0)"))))
def q6(spark, sf):
    return figures(quality.outlier_check(outlier_rows(spark, sf), "loan_master",
                                         ["fico_orig", "upb_orig", "skewed", "dti_orig"]))


@query("q6_outliers_nearest", " union all ".join(f"""
select 'outlier' as check_type, '{c}' as "column", 'outlier_pct' as metric, 'INFO' as status,
  round(1e2 * count(case when x < q1 - 15e-1 * (q3 - q1) or x > q3 + 15e-1 * (q3 - q1) then 1 end)
    / count(*), 4) as value
from (select {e} as x from @loans), (select
  max(case when i = floor((n - 1) * 25e-2 + 5e-1) then x end) as q1,
  max(case when i = floor((n - 1) * 75e-2 + 5e-1) then x end) as q3
  from (select {e} as x, row_number() over (order by {e}) - 1 as i, count(*) over () as n from @loans))"""
    for c, e in (("fico_orig", "fico_orig"), ("upb_orig", "upb_orig"),
                 ("skewed", "pow(upb_orig / 50000, 3e0)"))))
def q6_nearest(spark, sf):
    return figures(quality.outlier_check(outlier_rows(spark, sf), "loan_master",
                                         ["fico_orig", "upb_orig", "skewed", "dti_orig"], "nearest"))


@query("q7_schema_validation", """
select 'missing_columns' as metric, 0e0 as value, 'PASS' as status, count(*) as n from @loans""")
def q7(spark, sf):
    master = tables.master(spark, sf)
    rows = quality.Checks("loan_master").schema(master, list(master.columns)).run(master)
    n = master.agg(F.count(F.lit(1)).alias("n")).scalar()
    return rows.select("metric", "value", "status").withColumn("n", n)


def psi_sql(source: str, period: str, x: str, feature: str, bins: int = 10) -> str:
    """PSI of consecutive periods from first principles."""
    probs = ", ".join(f"{i / bins}" for i in range(bins + 1))
    return f"""
select '{feature}' as feature, a as "from", b as "to",
  case when n0 >= 20 and n1 >= 20 and len(edges) >= 3 then psi end as psi
from (
  select a, b, n0, n1, edges, sum((greatest(c1 / n1, 1e-6) - greatest(c0 / n0, 1e-6))
      * ln(greatest(c1 / n1, 1e-6) / greatest(c0 / n0, 1e-6))) as psi
  from (
    select a, b, n0, n1, edges, bin, cast(count(case when side = 0 then 1 end) as double) as c0,
      cast(count(case when side = 1 then 1 end) as double) as c1
    from (
      select a, b, n0, n1, edges, side, len(list_filter(edges[2:len(edges) - 1], lambda e: e <= x)) as bin
      from (select e.*, 0 as side, {x} as x from edges_{feature} e join {source} d on d.{period} = e.a
            union all
            select e.*, 1 as side, {x} as x from edges_{feature} e join {source} d on d.{period} = e.b)
      where x is not null)
    group by a, b, n0, n1, edges, bin)
  group by a, b, n0, n1, edges)"""


def edges_sql(source: str, period: str, x: str, feature: str, bins: int = 10) -> str:
    probs = ", ".join(f"{i / bins}" for i in range(bins + 1))
    return f"""edges_{feature} as materialized (
  select lag(g) over (order by g) as a, g as b, lag(n) over (order by g) as n0, n as n1,
    list_sort(list_distinct(lag(q) over (order by g))) as edges
  from (select {period} as g, count({x}) as n, quantile_cont({x}, [{probs}]) as q
        from {source} group by 1) qualify lag(g) over (order by g) is not null)"""


@query("q8_stability_index", f"""
with {edges_sql('@loans', 'vintage', 'fico_orig', 'fico_orig')}
select feature, "from", "to", round(psi, 8) as psi from (
{psi_sql('@loans', 'vintage', 'fico_orig', 'fico_orig')})""")
def q8(spark, sf):
    long = quality.long_values(tables.master(spark, sf), ["fico_orig"], ("vintage",))
    return drift.stability(long, "vintage").withColumn("psi", F.round("psi", 8))


@query("q9_drift", "with " + ", ".join(
    edges_sql("@loans", "vintage", f, f) for f in LIMITS.drift_features) + f"""
select 'drift' as check_type, feature as "column", concat('psi_', "to", '_vs_', "from") as metric,
  round(psi, 4) as value, case when psi > {LIMITS.psi_alert} then 'FAIL' when psi > {LIMITS.psi_warn}
  then 'WARN' else 'PASS' end as status
from (""" + " union all ".join(
    psi_sql("@loans", "vintage", f, f) for f in LIMITS.drift_features) + ") where psi is not null")
def q9(spark, sf):
    return figures(drift.drift_checks(tables.master(spark, sf)))


@query("q10_vintage_coverage", """
with p as (select distinct cast(substr(vintage, 1, 4) as bigint) * 4
    + cast(substr(vintage, 6, 1) as bigint) - 1 as q from @loans
  where vintage like '20%' and vintage <> '2000Q3')
select 'coverage' as check_type, 'vintage' as "column", 'missing_quarters' as metric,
  cast(max(q) - min(q) + 1 - count(*) as double) as value,
  case when max(q) - min(q) + 1 > count(*) then 'WARN' else 'PASS' end as status from p""")
def q10(spark, sf):
    rows = tables.master(spark, sf).filter(F.col("vintage") != "2000Q3")
    return figures(drift.coverage_check(rows))


@query("q11_quality_suite", """
select 'loan_monthly' as "table", 'completeness' as check_type, 6 as checks from @panel having count(*) > 0
union all select 'loan_monthly', 'uniqueness', 1
union all select 'loan_monthly', 'non_negative', 2
union all select 'loan_monthly', 'date_validity', 1
union all select 'loan_master', 'schema', 1
union all select 'loan_master', 'completeness', 8
union all select 'loan_master', 'uniqueness', 1
union all select 'loan_master', 'non_negative', 1
union all select 'loan_master', 'range', 4
union all select 'loan_master', 'date_validity', 1
union all select 'loan_master', 'outlier', 5
union all select 'loan_master', 'coverage', 1
union all select 'loan_master', 'drift', (count(distinct vintage) - 1) * 4 from @loans""")
def q11(spark, sf):
    from lossloom.plans.quality import quality_suite

    rows = quality_suite(tables.master(spark, sf), tables.monthly(spark, sf),
                         expected=[f.name for f in schema.LOAN_MASTER
                                   if f.name in tables.master(spark, sf).columns])
    return rows.groupBy("table", "check_type").agg(F.count(F.lit(1)).alias("checks"))


# Loans and months with every kind of fault, so that no check is trivially zero.
SPOILED = """
with loans as (
    select loan_id, case when loan_id % 19 <> 0 then origination_date end as origination_date, vintage,
      case when loan_id % 29 = 0 then -upb_orig else upb_orig end as upb_orig,
      case when loan_id % 17 = 0 then 900e0 when loan_id % 13 <> 0 then fico_orig end as fico_orig,
      ltv_orig, case when loan_id % 3 = 0 then dti_orig end as dti_orig, int_rate_orig, state
    from @loans),
  loan_master as (select * from loans union all select * from loans where loan_id % 31 = 0),
  loan_monthly as (
    select loan_id, case when loan_id % 23 <> 0 then reporting_period end as reporting_period,
      case when loan_id % 37 = 0 then -upb_current else upb_current end as upb_current, delq_status,
      case when loan_id % 11 <> 0 then loan_age end as loan_age, total_principal_current from @panel)
"""


def spoiled(spark, sf):
    k = F.col("loan_id")
    loans = tables.master(spark, sf).withColumns({
        "origination_date": F.when(k % 19 != 0, F.col("origination_date")),
        "upb_orig": F.when(k % 29 == 0, -F.col("upb_orig")).otherwise(F.col("upb_orig")),
        "fico_orig": F.when(k % 17 == 0, 900.0).when(k % 13 != 0, F.col("fico_orig")),
        "dti_orig": F.when(k % 3 == 0, F.col("dti_orig"))})
    months = tables.monthly(spark, sf).withColumns({
        "reporting_period": F.when(k % 23 != 0, F.col("reporting_period")),
        "upb_current": F.when(k % 37 == 0, -F.col("upb_current")).otherwise(F.col("upb_current")),
        "loan_age": F.when(k % 11 != 0, F.col("loan_age"))})
    return loans.unionByName(loans.filter(k % 31 == 0)), months


def values_sql() -> str:
    """Every value and status of the suite but drift, which has a query of its own."""
    rows = []

    def add(table, kind, column, metric, value, status):
        name = "null" if column is None else f"'{column}'"
        rows.append(f"select '{table}' as \"table\", '{kind}' as check_type, {name} as \"column\", "
                    f"'{metric}' as metric, v as value, {status} as status "
                    f"from (select cast({value} as double) as v from {table})")

    def count(bad):
        return f"count(case when {bad} then 1 end)"

    def share(bad):
        return f"round(1e2 * {count(bad)} / count(*), 4)"

    columns = {"loan_master": ("loan_id", "origination_date", "vintage", "upb_orig", "fico_orig",
                               "ltv_orig", "dti_orig", "int_rate_orig", "state"),
               "loan_monthly": ("loan_id", "reporting_period", "upb_current", "delq_status", "loan_age",
                                "total_principal_current")}
    core = {"loan_master": LIMITS.core_master, "loan_monthly": LIMITS.core_monthly}
    add("loan_master", "schema", None, "missing_columns", "0 * count(*)", "'PASS'")
    for t, own in columns.items():
        for c in core[t]:
            add(t, "completeness", c, "null_pct", share(f"{c} is null"),
                f"case when v > {LIMITS.max_null_pct} then 'FAIL' else 'PASS' end")
        add(t, "completeness", None, "sparse_columns", " + ".join(
            f"case when {share(f'{c} is null')} > 50 then 1 else 0 end" for c in own), "'INFO'")
        for c in (c for c in LIMITS.non_negative if c in own):
            add(t, "non_negative", c, "negative_count", count(f"{c} < 0"),
                "case when v > 0 then 'FAIL' else 'PASS' end")
        for c, (lo, hi) in LIMITS.date_bounds.items():
            if c in own:
                add(t, "date_validity", c, "invalid_date_pct", share(
                    f"{c} is null or {c} < date '{lo}' or {c} > date '{hi}'"),
                    "case when v > 0 then 'WARN' else 'PASS' end")
        keys = ("loan_id",) if t == "loan_master" else ("loan_id", "reporting_period")
        add(t, "uniqueness", "+".join(keys), "duplicate_rows",
            f"count(*) - count(distinct ({', '.join(f'coalesce(cast({k} as varchar), chr(0))' for k in keys)},))",
            "case when v > 0 then 'FAIL' else 'PASS' end")
    for c, (lo, hi) in LIMITS.numeric_ranges.items():
        if c in columns["loan_master"]:
            add("loan_master", "range", c, "out_of_range_pct", share(f"{c} < {lo} or {c} > {hi}"),
                "case when v > 0 then 'WARN' else 'PASS' end")
    for c in LIMITS.outlier_columns:
        add("loan_master", "outlier", c, "outlier_pct", share(
            f"{c} < q1 - 15e-1 * (q3 - q1) or {c} > q3 + 15e-1 * (q3 - q1)"), "'INFO'")
        rows[-1] = rows[-1].replace("from loan_master)", f"from loan_master, (select quantile_cont({c}, 0.25) as q1, "
                                    f"quantile_cont({c}, 0.75) as q3 from loan_master))")
    return SPOILED + " union all ".join(rows)


@query("q11_check_values", values_sql())
def q11_values(spark, sf):
    from lossloom.plans.quality import quality_suite

    loans, months = spoiled(spark, sf)
    rows = quality_suite(loans, months, expected=loans.columns)
    return rows.filter(~F.col("check_type").isin("drift", "coverage")).select(
        "table", "check_type", "column", "metric", "value", "status")
