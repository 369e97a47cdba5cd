"""Named parts of the reference SQL, mentioned as ``@name`` and put in front as CTEs.

Numeric literals that meet doubles are written with an exponent, so that they are doubles and not
decimals in every engine.
"""

from __future__ import annotations

import re

from lossloom.functions import normal
from lossloom.params import EventCodes, PdSettings

CODES = ", ".join(f"'{c}'" for c in EventCodes().default)
LOOSE = ", ".join(f"'{c}'" for c in EventCodes().default_loose)
PREPAY_LOOSE = ", ".join(f"'{c}'" for c in EventCodes().prepay_loose)

PARTS: dict[str, str] = {}

PARTS["loans"] = """
  select k as loan_id, cast(date_trunc('month', o_orderdate) as date) as origination_date,
    concat(cast(year(o_orderdate) as varchar), 'Q', cast(quarter(o_orderdate) as varchar)) as vintage,
    o_totalprice as upb_orig,
    cast(620 + (k * 37) % 200 as double) as fico_orig,
    cast(60 + (k * 13) % 38 as double) as ltv_orig,
    cast(20 + (k * 11) % 31 as double) as dti_orig,
    (30 + (k * 7) % 36) / 10 as int_rate_orig,
    concat(n_name, '') as state,
    cast(6 + (k * 17) % 43 as integer) as n_months
  from (select o_orderkey as k, o_custkey, o_totalprice, o_orderdate from orders)
  join customer on c_custkey = o_custkey
  join nation on n_nationkey = c_nationkey"""

PARTS["months"] = "select unnest(range(0, 49)) as m"

PARTS["panel"] = """
  select loan_id, cast(origination_date + to_months(cast(m as integer)) as date) as reporting_period,
    cast(m as double) as loan_age,
    case when m = 0 and loan_id % 3 = 0 then 0e0 else upb_orig * (360 - m) / 360 end
      as upb_current,
    int_rate_orig as int_rate_current,
    cast(360 - m as double) as remaining_months_to_maturity,
    case when loan_id % 97 = 0 and m = 3 then 'XX'
         when loan_id % 10 = 0 and m >= n_months - 6
           then concat('0', cast(m - (n_months - 7) as varchar))
         when loan_id % 7 = 0 and m % 12 in (5, 6) then '01' else '00' end as delq_status,
    case when m = n_months - 1 and loan_id % 20 = 0 then '09'
         when m = n_months - 1 and loan_id % 10 = 0 then '03'
         when m = n_months - 1 and loan_id % 10 in (1, 2, 3) then '01' end as zero_balance_code,
    case when m = 2 and loan_id % 5 = 0 then null else upb_orig / 360 end
      as total_principal_current,
    vintage, origination_date, fico_orig, ltv_orig, dti_orig, upb_orig, int_rate_orig, state
  from @loans join @months on m < n_months
  where not (loan_id % 11 = 0 and m = 4)"""

PARTS["vstats"] = """
  select vintage, count(*) as vintage_loan_count, avg(fico_orig) as vintage_avg_fico
  from @loans group by vintage"""

PARTS["numbered"] = """
  select *, case when regexp_full_match(delq_status, '[0-9]+') then cast(delq_status as bigint) end
      as delq_num,
    case when upb_current > 0 then upb_current end as balance from @panel"""

PARTS["feat"] = """
  select *, case when count_30dpd_12m > 0 then 1 when count_30dpd_12m is not null then 0 end
      as ever_30dpd_12m
  from (select n.*,
    row_number() over w - 1 as months_on_book,
    case when upb_orig > 0 then ltv_orig * balance / upb_orig end as current_ltv,
    case when upb_orig > 0 then 1 - balance / upb_orig end as upb_paydown_ratio,
    int_rate_current - int_rate_orig as rate_spread_vs_orig,
    case when total_principal_current is not null then sum(total_principal_current) over
      (w rows between unbounded preceding and current row) end as cum_principal_paid,
    balance / lag(balance, 3) over w - 1 as balance_change_3m,
    cast(delq_num - lag(delq_num, 3) over w as double) as delq_change_3m,
    max(delq_num) over (w rows between 5 preceding and current row) as max_delq_6m,
    max(delq_num) over (w rows between 11 preceding and current row) as max_delq_12m,
    cast(sum(cast(delq_num >= 1 as integer)) over (w rows between 11 preceding and current row)
      as bigint) as count_30dpd_12m
    from @numbered n window w as (partition by loan_id order by reporting_period))"""

PARTS["labelled"] = """
  select * exclude (ahead, months_left),
    cast(case when ahead = 1 then 1 when months_left >= 12 then 0 end as integer) as target
  from (select f.*,
      max(cast(coalesce(delq_num, 0) >= 3 as integer)) over
        (partition by loan_id order by reporting_period rows between 1 following and 12 following)
        as ahead,
      max(year(reporting_period) * 12 + month(reporting_period)) over (partition by loan_id)
        - (year(reporting_period) * 12 + month(reporting_period)) as months_left
    from @feat f)
  where coalesce(delq_num, 0) < 3
    and (ahead = 1 or months_left >= 12)"""

PARTS["closed"] = """
  select * from @labelled where year(reporting_period) * 12 + month(reporting_period) <=
    (select max(year(reporting_period) * 12 + month(reporting_period)) from @labelled) - 12"""

PARTS["terminal"] = f"""
  select loan_id,
    min(case when trim(zero_balance_code) in ({PREPAY_LOOSE}) then reporting_period end) as prepay_period,
    min(case when trim(zero_balance_code) in ({LOOSE}) then reporting_period end) as default_period,
    max(reporting_period) as last_period
  from @panel group by loan_id"""

PARTS["prepaylab"] = """
  select * from (
    select *, case when prepay_in and (dm is null or pm <= dm) then 1
                   when default_in and (pm is null or dm < pm) then null
                   when not prepay_in and not default_in and lm >= tm + 12 then 0 end as target
    from (select *, coalesce(pm > tm and pm <= tm + 12, false) as prepay_in,
                    coalesce(dm > tm and dm <= tm + 12, false) as default_in
      from (select f.*, year(prepay_period) * 12 + month(prepay_period) as pm,
              year(default_period) * 12 + month(default_period) as dm,
              year(last_period) * 12 + month(last_period) as lm,
              year(reporting_period) * 12 + month(reporting_period) as tm
            from @feat f left join @terminal using (loan_id))))
  where target is not null and coalesce(delq_num, 0) < 3
    and (pm is null or tm < pm) and (dm is null or tm < dm)"""

# Macro series from lineitem by ship month: prices and rates as means, output by quarter.
PARTS["observations"] = """
  select 'hpi' as series, cast(l_shipdate as date) as day, l_extendedprice as value from lineitem
  union all select 'treasury_10y', cast(l_shipdate as date), 100 * l_discount from lineitem
  union all select 'mortgage_30y', cast(l_shipdate as date), 100 * l_tax from lineitem
  union all select 'unemployment', cast(l_shipdate as date),
    case when l_returnflag = 'R' then 100e0 else 0e0 end from lineitem
  union all select 'real_gdp', cast(date_trunc('quarter', l_shipdate) as date), l_quantity from lineitem"""

PARTS["means"] = """
  select cast(date_trunc('month', day) as date) as reporting_period,
    avg(value) filter (where series = 'hpi') as hpi,
    avg(value) filter (where series = 'treasury_10y') as treasury_10y,
    avg(value) filter (where series = 'mortgage_30y') as mortgage_30y,
    avg(value) filter (where series = 'unemployment') as unemployment,
    avg(value) filter (where series = 'real_gdp') as real_gdp
  from @observations group by 1"""

PARTS["spine"] = """
  select cast(a + to_months(cast(i as integer)) as date) as reporting_period
  from (select min(reporting_period) as a, max(reporting_period) as b from @means)
  join (select unnest(range(0, 1200)) as i) on a + to_months(cast(i as integer)) <= b"""

PARTS["macro"] = """
  select *, (hpi / lag(hpi, 12) over (order by reporting_period) - 1) * 100 as hpi_yoy,
    (real_gdp / lag(real_gdp, 12) over (order by reporting_period) - 1) * 100 as gdp_yoy
  from (select s.reporting_period,
      last_value(hpi ignore nulls) over w as hpi,
      last_value(treasury_10y ignore nulls) over w as treasury_10y,
      last_value(mortgage_30y ignore nulls) over w as mortgage_30y,
      last_value(unemployment ignore nulls) over w as unemployment,
      last_value(real_gdp ignore nulls) over w as real_gdp
    from @spine s left join @means m on m.reporting_period = s.reporting_period
    window w as (order by s.reporting_period rows between unbounded preceding and current row))"""

# Liquidation amounts per order, spread over the cost and proceeds fields.
PARTS["amounts"] = """
  select l_orderkey as loan_id,
    sum(case when l_returnflag = 'A' then l_extendedprice * l_tax end) as foreclosure_costs,
    sum(case when l_returnflag = 'N' then l_extendedprice * l_tax end)
      as property_preservation_and_repair_costs,
    sum(case when l_returnflag = 'R' then l_extendedprice * l_tax end) as asset_recovery_costs,
    sum(case when l_linestatus = 'F' then l_extendedprice * (1 - l_discount) end) as net_sales_proceeds,
    sum(case when l_linestatus = 'O' then l_extendedprice * (1 - l_discount) end)
      as other_foreclosure_proceeds
  from lineitem group by l_orderkey"""

PARTS["events_lgd"] = f"""
  select p.loan_id, reporting_period as default_period, upb_current, loan_age, ltv_orig, fico_orig,
    upb_orig, origination_date, state,
    case when p.loan_id % 4 = 0 then upb_orig * 9e-1 end as upb_at_the_time_of_removal,
    foreclosure_costs, property_preservation_and_repair_costs, asset_recovery_costs,
    net_sales_proceeds, other_foreclosure_proceeds
  from @panel p left join @amounts a on a.loan_id = p.loan_id
  where trim(zero_balance_code) in ({CODES})"""

PARTS["losses"] = """
  select *, least(greatest(lgd_raw, 0), 1) as lgd from (
    select *, net_loss / nullif(default_upb, 0) as lgd_raw from (
      select *, case when costs + proceeds > 0 then default_upb + costs - proceeds end as net_loss
      from (select *,
          case when upb_at_the_time_of_removal > 0 then upb_at_the_time_of_removal
               when upb_current > 0 then upb_current else 0 end as default_upb,
          coalesce(foreclosure_costs, 0) + coalesce(property_preservation_and_repair_costs, 0)
            + coalesce(asset_recovery_costs, 0) as costs,
          coalesce(net_sales_proceeds, 0) + coalesce(other_foreclosure_proceeds, 0) as proceeds
        from @events_lgd)))
  where lgd_raw is not null and default_upb > 0"""

PARTS["lgd"] = """
  select l.*, coalesce(ltv_orig * default_upb / upb_orig * a.hpi / b.hpi,
                       ltv_orig * default_upb / upb_orig) as mtm_ltv,
    loan_age / 12 as loan_age_years
  from @losses l
  left join @macro a on a.reporting_period = date_trunc('month', l.origination_date)
  left join @macro b on b.reporting_period = date_trunc('month', l.default_period)"""

PARTS["exposures"] = """
  select loan_id, reporting_period, upb_current, int_rate_current as note_rate,
    remaining_months_to_maturity as remaining_term
  from @panel where upb_current > 0 and remaining_months_to_maturity > 0"""

PARTS["latest"] = """
  select loan_id, upb_current as upb, note_rate as rate, remaining_term as term from (
    select *, row_number() over (partition by loan_id order by reporting_period desc) as rn
    from @exposures) where rn = 1"""

# A closed-form score stands in for a fitted model: evaluated identically by every engine.
SCORE = ("round(least(9e-1, 4e-3 + 3e-2 * coalesce(delq_num, 0) + 1e-4 * (820 - fico_orig)"
         " + 2e-4 * greatest(coalesce(current_ltv, 8e1) - 60, 0)"
         " + 2e-3 * coalesce(count_30dpd_12m, 0)), 10)")

PARTS["snapshot"] = f"""
  select loan_id, reporting_period, delq_num, coalesce(pd_orig, pd_now) as pd_orig, pd_now
  from (select loan_id, {SCORE} as pd_now, reporting_period, delq_num from (
      select *, row_number() over (partition by loan_id order by reporting_period desc) as rn
      from @feat) where rn = 1)
  left join (select loan_id, {SCORE} as pd_orig from (
      select *, row_number() over (partition by loan_id order by loan_age, reporting_period) as rn
      from @feat) where rn = 1) using (loan_id)"""

STAGE = """case when delq_num >= 3 then 3
    when delq_num >= 1 or pd_now / greatest(pd_orig, 1e-6) >= 2e0 or pd_now - pd_orig >= 1e-2 then 2
    else 1 end"""

PARTS["staged"] = f"""
  select *, {STAGE} as stage, delq_num >= 3 as is_default, delq_num >= 1 as sicr_backstop_30dpd,
    (pd_now / greatest(pd_orig, 1e-6) >= 2e0 or pd_now - pd_orig >= 1e-2) as sicr_pd_deterioration
  from @snapshot"""

PARTS["book"] = """
  select s.loan_id, pd_now as pd12, stage, upb, rate, term from @staged s
  join @latest using (loan_id)"""

PARTS["scored"] = f"""
  select *, {SCORE} as p, cast(date_trunc('quarter', reporting_period) as date) as period
  from @closed"""


def number(x: float) -> str:
    text = repr(float(x))
    return text if "e" in text else text + "e0"


def poly(coefficients: list[float], x: str) -> str:
    out = number(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out}) * {x} + {number(c)}"
    return f"({out})"


def cdf(x: str) -> str:
    """Normal distribution function with the coefficients of lossloom.functions.normal."""
    z = f"abs({x})"
    near = (f"exp(-{z} * {z} / 2) * {poly(normal.CDF_NUM, z)} / {poly(normal.CDF_DEN, z)}")
    far = f"({z} + 0.65e0)"
    for step in (4, 3, 2, 1):
        far = f"({z} + {step}e0 / {far})"
    far = f"exp(-{z} * {z} / 2) / {far} / {number(normal.ROOT_TWO_PI)}"
    tail = (f"(case when {z} > 37 then 0e0 when {z} < {number(normal.CDF_SPLIT)} then {near} "
            f"else {far} end)")
    return f"(case when {x} > 0 then 1 - {tail} else {tail} end)"


def ppf(p: str) -> str:
    q = f"({p} - 0.5e0)"
    mid = f"(0.180625e0 - {q} * {q})"
    centre = f"{q} * {poly(normal.Q_MID_NUM, mid)} / {poly(normal.Q_MID_DEN, mid)}"
    r = f"sqrt(-ln(case when {q} < 0 then {p} else 1 - {p} end))"
    near, far = f"({r} - 1.6e0)", f"({r} - 5e0)"
    tail = (f"(case when {r} <= 5 then {poly(normal.Q_NEAR_NUM, near)} / {poly(normal.Q_NEAR_DEN, near)}"
            f" else {poly(normal.Q_FAR_NUM, far)} / {poly(normal.Q_FAR_DEN, far)} end)")
    return (f"(case when abs({q}) <= 0.425e0 then {centre} "
            f"else case when {q} < 0 then -{tail} else {tail} end end)")


def inside(p: str) -> str:
    return f"least(greatest({p}, 1e-6), 1 - 1e-6)"


PD_FEATURES = list(PdSettings().features)


def with_parts(text: str) -> str:
    """Put the parts that ``text`` mentions, directly or through other parts, in front of it."""
    needed: set[str] = set()

    def visit(body: str) -> None:
        for name in re.findall(r"@(\w+)", body):
            if name not in needed:
                needed.add(name)
                visit(PARTS[name])

    def plain(body: str) -> str:
        return re.sub(r"@(\w+)", r"t_\1", body)

    visit(text)
    ctes = ",\n".join(f"t_{n} as materialized ({plain(PARTS[n])})" for n in PARTS if n in needed)
    body = plain(text.strip())
    if not ctes:
        return body
    if body.lower().startswith("with recursive "):
        return f"with recursive {ctes},\n{body[15:]}"
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
