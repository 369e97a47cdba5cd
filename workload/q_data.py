"""Sources, sinks, projections and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossloom import schema
from lossloom.functions import dates, delinquency
from lossloom.operators import features, labels, regression, sampling, severity, staging
from lossloom.sources import feature_store, raw_files, results, warehouse
from lossloom.sources.versions import VersionedWarehouse
from workload import sql, tables
from workload.common import (
    CELL,
    closed,
    digest,
    digest_sql,
    feat,
    labelled,
    losses,
    macro_table,
    scratch,
    snapshot,
    staged,
)
from workload.registry import query

# ---- sources and sinks ---------------------------------------------------------------------

FILE_SQL = """select concat('Performance_', case when loan_id % 4 = 0 then replace(vintage, 'Q', '-Q')
    when loan_id % 4 = 1 then replace(vintage, 'Q', ' q') when loan_id % 4 = 2 then
    replace(vintage, 'Q', 'x') else vintage end,
    case when loan_id % 3 = 0 then '.csv' when loan_id % 3 = 1 then '.TXT' else '.zip' end) as file
  from @loans"""


def file_names(spark, sf):
    k, v = F.col("loan_id"), F.col("vintage")
    styled = (F.when(k % 4 == 0, F.replace(v, F.lit("Q"), F.lit("-Q")))
              .when(k % 4 == 1, F.replace(v, F.lit("Q"), F.lit(" q")))
              .when(k % 4 == 2, F.replace(v, F.lit("Q"), F.lit("x"))).otherwise(v))
    end = F.when(k % 3 == 0, ".csv").when(k % 3 == 1, ".TXT").otherwise(".zip")
    return tables.loans(spark, sf).select(F.concat(F.lit("Performance_"), styled, end)
                                          .alias("file"))


VINTAGE_SQL = r"""nullif(concat(regexp_extract(file, '(20\d{2})[\-_ ]?[Qq]([1-4])', 1),
    case when regexp_matches(file, '(20\d{2})[\-_ ]?[Qq]([1-4])') then 'Q' else '' end,
    regexp_extract(file, '(20\d{2})[\-_ ]?[Qq]([1-4])', 2)), '')"""


@query("s1_detect_files", f"""
select file, vintage, count(*) as n from (select file, {VINTAGE_SQL} as vintage from ({FILE_SQL}))
where vintage is not null and regexp_matches(lower(file), '\\.(csv|txt)$') group by file, vintage""")
def s1(spark, sf):
    found = raw_files.quarterly_files(file_names(spark, sf))
    return found.groupBy("file", "vintage").agg(F.count(F.lit(1)).alias("n"))


@query("s2_parse_vintage", f"""
select vintage, count(*) as n from (select {VINTAGE_SQL} as vintage from ({FILE_SQL})) group by vintage""")
def s2(spark, sf):
    return (file_names(spark, sf).groupBy(dates.vintage_in_name("file").alias("vintage"))
            .agg(F.count(F.lit(1)).alias("n")))


def raw_lines(spark, sf, ranges=()):
    """Loan months written as pipe-delimited text, some lines with surplus or bad fields."""
    month = F.date_format("reporting_period", "MMyyyy")
    k = F.col("loan_id")
    text = {
        "loan_id": k.cast("string"),
        "reporting_period": F.when(k % 53 == 0, "13x018").otherwise(month),
        "upb_current": F.when(k % 59 == 0, "n/a").otherwise(F.col("upb_current").cast("string")),
        "fico_orig": F.col("fico_orig").cast("string"),
        "delq_status": F.col("delq_status"),
        "zero_balance_code": F.col("zero_balance_code"),
        "origination_date": F.date_format("origination_date", "MMyyyy"),
    }
    pieces, bars = [], ""
    for i, c in enumerate(schema.raw_field_names(108)):
        bars += "|" if i else ""
        if c in text:
            pieces += [F.lit(bars), F.coalesce(text[c], F.lit(""))]
            bars = ""
    end = F.when(k % 61 == 0, F.lit(bars + "|extra|extra")).otherwise(F.lit(bars))
    return tables.full_panel(spark, sf, ranges).select(
        "vintage", F.concat(*pieces, end).alias("line"))


# File names carry years of this century only; the derived loans begin in 1995.
LATER = 10
LATER_SQL = f"concat(cast(substr(vintage, 1, 4) as int) + {LATER}, substr(vintage, 5))"


# The lines are mostly empty fields, so the files are packed; one of them is read by one task.
PACKED, FILE_LINES = (".gz",), 1_000_000


def raw_folder(spark, sf) -> str:
    """The same lines as packed quarterly text files, named as they are delivered, LATER years on.

    The loans are placed by quarter before they become lines, so no line is shuffled or sorted.
    """
    folder = scratch(spark)
    later = F.concat(F.substring("vintage", 1, 4).cast("int") + LATER, F.substring("vintage", 5, 2))
    lines = raw_lines(spark, sf, ("vintage", "loan_id")).withColumn("vintage", later)
    with warehouse.open_writers(spark):
        lines.write.partitionBy("vintage").option("maxRecordsPerFile", FILE_LINES).option(
            "compression", "gzip").text(f"{folder}/out")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(f"{folder}/raw"))
    for quarter in fs.listStatus(path(f"{folder}/out")):  # a few dozen quarters
        name = quarter.getPath().getName()
        if name.startswith("vintage="):
            for k, f in enumerate(fs.listStatus(quarter.getPath())):
                fs.rename(f.getPath(), path(f"{folder}/raw/Performance_{name[8:]}_{k}.csv.gz"))
    return f"{folder}/raw"


def raw_paths(spark, folder: str) -> list[str]:
    return [r["path"] for r in raw_files.list_files(spark, folder, PACKED).collect()]


@query("s3_raw_scan", f"""
select {LATER_SQL} as vintage, count(*) as n, count(zero_balance_code) as coded,
  count(case when loan_id % 59 <> 0 then 1 end) as numeric_upb,
  round(sum(case when loan_id % 59 <> 0 then upb_current end), 2) as upb,
  count(case when loan_id % 53 <> 0 then 1 end) as dated,
  min(case when loan_id % 53 <> 0 then reporting_period end) as first_month,
  max(origination_date) as last_origination, sum(fico_orig) as fico
from @panel group by vintage""")
def s3(spark, sf):
    rows = raw_files.loan_level(spark, raw_paths(spark, raw_folder(spark, sf)))
    return rows.groupBy("vintage").agg(
        F.count(F.lit(1)).alias("n"), F.count("zero_balance_code").alias("coded"),
        F.count("upb_current").alias("numeric_upb"),
        F.round(F.sum("upb_current"), 2).alias("upb"),
        F.count("reporting_period").alias("dated"),
        F.min("reporting_period").alias("first_month"),
        F.max("origination_date").alias("last_origination"), F.sum("fico_orig").alias("fico"))


@query("s4_positional_names", """
select width, count(*) as n, count(case when width > 108 then 1 end) as padded
from (select case when loan_id % 61 = 0 then 110 else 108 end as width from @panel) group by width""")
def s4(spark, sf):
    rows = raw_files.read_raw(spark, raw_paths(spark, raw_folder(spark, sf)), width=110)
    width = F.when(F.col("extra_field_110").isNotNull(), 110).otherwise(108)
    return rows.groupBy(width.alias("width")).agg(
        F.count(F.lit(1)).alias("n"), F.count("extra_field_109").alias("padded"))


@query("s3_parsed_lines", """
select vintage, count(*) as n, count(case when loan_id % 59 <> 0 then 1 end) as numeric_upb,
  count(case when loan_id % 53 <> 0 then 1 end) as dated from @panel group by vintage""")
def s3_lines(spark, sf):
    rows = raw_files.with_types(raw_files.parse_lines(
        raw_lines(spark, sf), columns=["reporting_period", "upb_current"]))
    return rows.groupBy("vintage").agg(
        F.count(F.lit(1)).alias("n"), F.count("upb_current").alias("numeric_upb"),
        F.count("reporting_period").alias("dated"))


@query("s17_ingest", f"""
select {LATER_SQL} as vintage, count(distinct loan_id) as rows_master, count(*) as rows_monthly,
  'SUCCESS' as status, count(*) as stored from @panel group by vintage""")
def s17(spark, sf):
    from lossloom.plans.ingest import ingest

    root = scratch(spark)
    audit = ingest(spark, raw_folder(spark, sf), root, extensions=PACKED)
    stored = VersionedWarehouse(spark, root).read("loan_monthly").groupBy("vintage").agg(
        F.count(F.lit(1)).alias("stored"))
    return audit.join(stored, "vintage").select("vintage", "rows_master", "rows_monthly", "status",
                                                "stored")


@query("s5_vintage_parquet", "select vintage, count(*) as n from @panel group by vintage")
def s5(spark, sf):
    store = warehouse.Warehouse(spark, scratch(spark))
    store.replace_vintages(tables.monthly(spark, sf), "loan_monthly")
    return store.read("loan_monthly").groupBy("vintage").agg(F.count(F.lit(1)).alias("n"))


@query("s6_row_count", "select count(*) as n from @panel")
def s6(spark, sf):
    return tables.monthly(spark, sf).agg(F.count(F.lit(1)).alias("n"))


@query("s7_column_read", "select o_orderkey, o_totalprice from orders")
def s7(spark, sf):
    return warehouse.Warehouse(spark, sf).read("orders.parquet", ["o_orderkey", "o_totalprice"])


@query("s8_table_append", """
select vintage, 2 * count(*) as n from @loans group by vintage""")
def s8(spark, sf):
    store = warehouse.Warehouse(spark, scratch(spark))
    for _ in range(2):
        store.append(tables.master(spark, sf), "loan_master")
    return store.read("loan_master").groupBy("vintage").agg(F.count(F.lit(1)).alias("n"))


@query("s9_reload_vintage", """
select vintage, case when vintage = '1996Q2' then count(case when fico_orig >= 700 then 1 end)
  else count(*) end as n from @loans group by vintage""")
def s9(spark, sf):
    store = warehouse.Warehouse(spark, scratch(spark))
    master = tables.master(spark, sf)
    store.replace_vintages(master, "loan_master")
    corrected = master.filter((F.col("vintage") == "1996Q2") & (F.col("fico_orig") >= 700))
    for _ in range(2):
        store.replace_vintages(corrected, "loan_master")
    return store.read("loan_master").groupBy("vintage").agg(F.count(F.lit(1)).alias("n"))


@query("s9_atomic_reload", """
with months as (select vintage, count(*) as whole, count(case when fico_orig >= 700 then 1 end) as good
    from @panel group by vintage),
  w as (select vintage, count(*) as loans, any_value(m.whole) as months,
    count(case when fico_orig >= 700 then 1 end) as good_loans, any_value(m.good) as good_months
    from @loans join months m using (vintage) group by vintage)
select state, vintage,
  case when state = 'reloaded' and vintage like '1996%' then good_loans else loans end as loans,
  case when state = 'reloaded' and vintage like '1996%' then good_months else months end as months,
  case when state = 'reloaded' and vintage like '1996%' then 2 else 1 end as loads
from w, (select unnest(['loaded', 'failed', 'pinned', 'reloaded']) as state)""")
def s9_atomic(spark, sf):
    """Two tables and a log: after a load, after one that failed half way, after a reload, and as a
    reader sees them that opened the tables before it."""
    store = VersionedWarehouse(spark, scratch(spark))
    master, monthly = tables.master(spark, sf), tables.monthly(spark, sf)

    def reload(loans, broken=False):
        keep = loans.select("loan_id")
        with store.load() as change:
            change.replace_vintages(loans, "loan_master")
            if broken:
                raise RuntimeError("between two tables")
            change.replace_vintages(monthly.join(keep, "loan_id", "left_semi"), "loan_monthly")
            change.append(loans.select("vintage").distinct(), "log")

    def state(name, at):
        per = at.read("loan_master").groupBy("vintage").agg(F.count(F.lit(1)).alias("loans"))
        months = at.read("loan_monthly").groupBy("vintage").agg(F.count(F.lit(1)).alias("months"))
        loads = at.read("log").groupBy("vintage").agg(F.count(F.lit(1)).alias("loads"))
        return per.join(months, "vintage").join(loads, "vintage").withColumn("state", F.lit(name))

    reload(master)
    out = state("loaded", store.snapshot())
    better = master.filter(F.col("vintage").startswith("1996") & (F.col("fico_orig") >= 700))
    try:
        reload(better, broken=True)
    except RuntimeError:
        out = out.unionByName(state("failed", store.snapshot()))
    pinned = store.snapshot()
    reload(better)
    return out.unionByName(state("pinned", pinned)).unionByName(state("reloaded", store))


@query("i1_row_corrections", """
select vintage, count(*) as n, sum(case when loan_id % 14 = 0 then 3 when loan_id % 7 = 0 then 2
    else 1 end)::bigint as versions,
  round(sum(upb_current * case when loan_id % 14 = 0 then 25e-2 when loan_id % 7 = 0 then 5e-1
    else 1e0 end), 2) as upb
from @panel group by vintage""")
def i1(spark, sf):
    """Third versions arrive before second ones, and the whole history arrives again at the end."""
    from lossloom.streaming.corrections import start_corrections

    root, k = scratch(spark), F.col("loan_id")
    rows = tables.monthly(spark, sf).select("loan_id", "reporting_period", "upb_current", "vintage")

    def version(n, share, kept=F.lit(True)):
        return rows.filter(kept).withColumn("upb_current", F.col("upb_current") * share).withColumn(
            "version", F.lit(n))

    # A version is as many files as the panel has parts, and one batch.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def merge(checkpoint):
        start_corrections(spark, f"{root}/in", f"{root}/wh", f"{root}/{checkpoint}", "rows", 2,
                          max_files=parts, stream=checkpoint).awaitTermination()
        VersionedWarehouse(spark, f"{root}/wh").vacuum(1)  # nobody reads the parts it replaced

    for part in (version(3, .25, k % 14 == 0), version(1, 1.0), version(2, .5, k % 7 == 0)):
        part.write.mode("append").parquet(f"{root}/in")
        merge("first")
    for checkpoint in ("first", "again"):  # nothing new, all files once more
        merge(checkpoint)
    return VersionedWarehouse(spark, f"{root}/wh").read("rows").groupBy("vintage").agg(
        F.count(F.lit(1)).alias("n"), F.sum("version").alias("versions"),
        F.round(F.sum("upb_current"), 2).alias("upb"))


def audit_log(spark, sf):
    counts = tables.loans(spark, sf).groupBy("vintage").agg(
        F.count(F.lit(1)).alias("rows_master"), F.sum("n_months").alias("rows_monthly"))
    counts = counts.withColumn("source_file", F.concat("vintage", F.lit(".csv")))
    odd = F.substring("vintage", 6, 1).isin("1", "3")
    return warehouse.log_rows(counts.filter(odd), "SUCCESS", 1.0).unionByName(
        warehouse.log_rows(counts.filter(~odd), "FAILED", 1.0, "unreadable " * 80))


@query("s10_incremental_skip", """
select vintage, count(*) as n from @loans where vintage not in
  (select vintage from @loans where substr(vintage, 6, 1) in ('1', '3')) group by vintage""")
def s10(spark, sf):
    files = tables.loans(spark, sf).groupBy("vintage").agg(F.count(F.lit(1)).alias("n"))
    return warehouse.not_yet_ingested(files, audit_log(spark, sf))


@query("s11_audit_rows", """
select vintage, concat(vintage, '.csv') as source_file, count(*) as rows_master,
  cast(sum(n_months) as bigint) as rows_monthly, 1.0::double as sample_fraction,
  case when substr(vintage, 6, 1) in ('1', '3') then 'SUCCESS' else 'FAILED' end as status,
  case when substr(vintage, 6, 1) in ('1', '3') then 0 else 500 end as message_length
from @loans group by vintage""")
def s11(spark, sf):
    return audit_log(spark, sf).withColumn("message_length", F.length("message")).drop(
        "message", "finished_at")


DICTIONARY = ["upb_current", "loan_age", "delq_status", "zero_balance_code",
              "total_principal_current", "int_rate_current", "remaining_months_to_maturity"]
OFFICIAL = ["Current Actual UPB", "Loan Age", "Current Loan Delinquency Status",
            "Zero Balance Code", "Total Principal Current", "Current Interest Rate",
            "Remaining Months To Maturity"]


@query("s12_data_dictionary", " union all ".join(
    f"select 'loan_monthly' as table_name, '{c}' as db_column, '{o}' as official_name, "
    f"'{'text' if c in ('delq_status', 'zero_balance_code') else 'numeric'}' as data_type, "
    f"false as is_static, count({c}) as filled from @panel" for c, o in zip(DICTIONARY, OFFICIAL)))
def s12(spark, sf):
    monthly = tables.monthly(spark, sf)
    present = [c for c in monthly.columns if c not in ("loan_id", "reporting_period", "vintage")]
    filled = monthly.agg(*[F.count(c).alias(c) for c in present]).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("db_column"), F.col(c).alias("filled")) for c in present]))
        .alias("v")).select("v.*")
    dictionary = warehouse.data_dictionary(spark)
    known = dictionary.filter(F.col("table_name") == "loan_master")
    return warehouse.missing_entries(dictionary, known).join(filled, "db_column")


@query("s13_feature_store", digest_sql("current_ltv", "@feat", "vintage"))
def s13(spark, sf):
    store = warehouse.Warehouse(spark, scratch(spark))
    placed = feature_store.place_loans(tables.loans(spark, sf))
    rows = features.with_features(tables.loan_months(placed, feature_store.HOME),
                                  placed=(feature_store.HOME,))
    # A loan with an early row has an early home, so the other loans are left out before the windows.
    early = (F.col(feature_store.HOME) < "1997") & (F.col("vintage") < "1997")
    feature_store.reset(store, rows.filter(early))
    feature_store.write(store, rows)
    return digest(feature_store.scan(store), "current_ltv", "vintage")


@query("s14_macro_table", """
select reporting_period, round(hpi, 6) as hpi, round(unemployment, 6) as unemployment from @macro""")
def s14(spark, sf):
    store = warehouse.Warehouse(spark, scratch(spark))
    store.replace(macro_table(spark, sf), "macro_data")
    return store.read("macro_data").select(
        "reporting_period", F.round("hpi", 6).alias("hpi"),
        F.round("unemployment", 6).alias("unemployment"))


@query("s15_result_tables", "select stage, count(*) as n from @staged group by stage")
def s15(spark, sf):
    store = results.Results(spark, scratch(spark))
    staged_counts = staged(spark, sf).groupBy("stage").agg(F.count(F.lit(1)).alias("n"))
    store.replace(staged_counts, "stages")
    store.save_json(store.get("stages"), "stages")
    return spark.read.json(store.path("stages") + ".json", schema="stage int, n bigint")


@query("s16_quality_results", """
select '20240101_000000' as run_id, 'loan_monthly' as table_name, 'non_negative' as check_type,
  'upb_current' as column_name, 'negative_count' as metric,
  cast(count(case when upb_current < 0 then 1 end) as double) as value, 0e0 as threshold,
  case when count(case when upb_current < 0 then 1 end) > 0 then 'FAIL' else 'PASS' end as status
from @panel""")
def s16(spark, sf):
    from lossloom.operators.quality import Checks

    monthly = tables.monthly(spark, sf)
    rows = Checks("loan_monthly").non_negative(monthly, ("upb_current",)).run(monthly)
    store = warehouse.Warehouse(spark, scratch(spark))
    store.append(results.quality_rows(rows, "20240101_000000"), "dq_results")
    return store.read("dq_results").drop("run_ts", "message")


# ---- projections and predicates ------------------------------------------------------------


@query("p1_canonical_names", """
select loan_id, vintage, upb_orig, fico_orig, state from @loans""")
def p1(spark, sf):
    official = {"Loan Identifier": "loan_id", "Original UPB": "upb_orig",
                "Borrower Credit Score at Origination": "fico_orig", "Property State": "state"}
    raw = tables.loans(spark, sf).select("vintage", *[F.col(c).alias(o)
                                                      for o, c in official.items()])
    return raw.select("vintage", *[F.col(f"`{o}`").alias(schema.column_name(o))
                                   for o in official])


@query("p2_lenient_number", """
select vintage, count(try_cast(t as double)) as known, round(sum(try_cast(t as double)), 2) as total
from (select vintage, case when loan_id % 7 = 0 then 'n/a' when loan_id % 7 = 1 then ''
  else cast(upb_orig as varchar) end as t from @loans) group by vintage""")
def p2(spark, sf):
    k = F.col("loan_id")
    text = (F.when(k % 7 == 0, "n/a").when(k % 7 == 1, "")
            .otherwise(F.col("upb_orig").cast("string")))
    number = text.try_cast("double")
    return tables.loans(spark, sf).groupBy("vintage").agg(
        F.count(number).alias("known"), F.round(F.sum(number), 2).alias("total"))


@query("p3_lenient_month", """
select case when loan_id % 5 in (0, 1) then null else origination_date end as month, count(*) as n
from @loans group by 1""")
def p3(spark, sf):
    k = F.col("loan_id")
    text = (F.when(k % 5 == 0, F.concat(F.lit("13"), F.date_format("origination_date", "yyyy")))
            .when(k % 5 == 1, "unknown").otherwise(F.date_format("origination_date", "MMyyyy")))
    return tables.loans(spark, sf).groupBy(dates.parse_month(text).alias("month")).agg(
        F.count(F.lit(1)).alias("n"))


@query("p4_vintage_label", "select loan_id, vintage from @loans")
def p4(spark, sf):
    return tables.read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("loan_id"),
        dates.vintage_of(F.col("o_orderdate").cast("date")).alias("vintage"))


HASH_SQL = "cast(concat('0x', substr(md5(cast(loan_id as varchar)), 1, 8)) as bigint)"


@query("p5_entity_sample", f"""
select vintage, count(*) as n, count(distinct loan_id) as loans from @panel
where {HASH_SQL} % 1000000 < 300000 group by vintage""")
def p5(spark, sf):
    kept = sampling.sample_loans(tables.monthly(spark, sf), 0.3)
    return kept.groupBy("vintage", "loan_id").agg(F.count(F.lit(1)).alias("c")).groupBy(
        "vintage").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("loans"))


@query("p6_one_in_n", f"""
select loan_id, count(*) as n from @panel where {HASH_SQL} % 50 = 0 group by loan_id""")
def p6(spark, sf):
    return sampling.sample_one_in(tables.monthly(spark, sf), 50).groupBy("loan_id").agg(
        F.count(F.lit(1)).alias("n"))


@query("p7_delinquency_months", """
select delq_status, delq_num, count(*) as n from @numbered group by all""")
def p7(spark, sf):
    return (tables.monthly(spark, sf)
            .groupBy("delq_status", delinquency.months_past_due("delq_status").alias("delq_num"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("p8_past_due", """
select vintage, count(case when delq_num >= 1 then 1 end) as late30,
  count(case when delq_num >= 3 then 1 end) as late90 from @numbered group by vintage""")
def p8(spark, sf):
    return tables.monthly(spark, sf).groupBy("vintage").agg(
        F.count_if(delinquency.at_least("delq_status", 1)).alias("late30"),
        F.count_if(delinquency.at_least("delq_status", 3)).alias("late90"))


@query("p9_usable_balance", digest_sql("root", "(select *, sqrt(balance) as root from @numbered)",
                                       *CELL))
def p9(spark, sf):
    rows = tables.full_panel(spark, sf).withColumn(
        "root", F.sqrt(delinquency.usable_balance("upb_current")))
    return digest(rows, "root", *CELL)


for _name, _column in (("p10_current_ltv", "current_ltv"), ("p11_paydown_ratio", "upb_paydown_ratio"),
                       ("p12_rate_spread", "rate_spread_vs_orig")):
    query(_name, digest_sql(_column, "@feat", *CELL))(
        lambda spark, sf, c=_column: digest(feat(spark, sf), c, *CELL))


def feature_rows(spark, sf):
    return features.feature_table(tables.monthly(spark, sf), tables.master(spark, sf),
                                  macro_table(spark, sf))


@query("p13_feature_projection", """
select loan_id, count(*) as n, min(vintage) as vintage, min(state) as state,
  cast(sum(months_on_book) as bigint) as months_on_book, count(hpi_yoy) as with_macro,
  max(vintage_loan_count) as vintage_loan_count, cast(sum(count_30dpd_12m) as bigint) as count_30dpd_12m,
  round(sum(current_ltv), 4) as current_ltv, round(sum(treasury_10y), 4) as treasury_10y
from @feat join @vstats using (vintage) left join @macro using (reporting_period) group by loan_id""")
def p13(spark, sf):
    return feature_rows(spark, sf).groupBy("loan_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("vintage").alias("vintage"),
        F.min("state").alias("state"), F.sum("months_on_book").alias("months_on_book"),
        F.count("hpi_yoy").alias("with_macro"),
        F.max("vintage_loan_count").alias("vintage_loan_count"),
        F.sum("count_30dpd_12m").alias("count_30dpd_12m"),
        F.round(F.sum("current_ltv"), 4).alias("current_ltv"),
        F.round(F.sum("treasury_10y"), 4).alias("treasury_10y"))


INCENTIVE_SQL = """
select vintage, loan_age, count(*) as n, count(i) as known, round(sum(i), 4) as incentive,
  round(sum(i * (least(greatest(months_on_book, 0), 60) / 12)), 4) as burnout
from (select f.*, int_rate_orig + coalesce(rate_spread_vs_orig, 0) - mortgage_30y as i
  from @labelled f left join @macro using (reporting_period)) group by vintage, loan_age"""


@query("p14_refi_incentive", INCENTIVE_SQL)
def p14(spark, sf):
    rows = labels.with_refi_incentive(labelled(spark, sf), macro_table(spark, sf))
    return rows.groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("n"), F.count("refi_incentive").alias("known"),
        F.round(F.sum("refi_incentive"), 4).alias("incentive"),
        F.round(F.sum("incentive_burnout"), 4).alias("burnout"))


@query("p15_month_index", """
select year(reporting_period) * 12 + month(reporting_period) as month_index, count(*) as n
from @panel group by 1""")
def p15(spark, sf):
    return tables.monthly(spark, sf).groupBy(
        dates.month_number("reporting_period").alias("month_index")).agg(
        F.count(F.lit(1)).alias("n"))


@query("p16_quarter_bucket", """
select cast(date_trunc('quarter', reporting_period) as date) as period, count(*) as n
from @panel group by 1""")
def p16(spark, sf):
    return tables.monthly(spark, sf).groupBy(
        dates.quarter_start("reporting_period").alias("period")).agg(F.count(F.lit(1)).alias("n"))


@query("p17_time_split", """
select case when reporting_period < date '2000-01-01' then 'train' else 'test' end as split,
  count(*) as n, cast(sum(target) as bigint) as positives from @labelled group by 1""")
def p17(spark, sf):
    return labels.with_split(labelled(spark, sf), "2000-01-01").groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("target").alias("positives"))


@query("p18_drop_open_window", """
select reporting_period, count(*) as n, cast(sum(target) as bigint) as positives from @closed group by 1""")
def p18(spark, sf):
    return closed(spark, sf).groupBy("reporting_period").agg(
        F.count(F.lit(1)).alias("n"), F.sum("target").alias("positives"))


@query("p19_code_filter", f"""
select zero_balance_code, count(*) as n from @panel
where trim(zero_balance_code) in ({sql.CODES}) group by 1""")
def p19(spark, sf):
    padded = tables.monthly(spark, sf).withColumn(
        "padded", F.concat(F.lit(" "), "zero_balance_code", F.lit(" ")))
    return padded.filter(delinquency.code_in("padded", ("02", "03", "09", "15"))).groupBy(
        "zero_balance_code").agg(F.count(F.lit(1)).alias("n"))


@query("p20_period_filter", """
select loan_id, delq_status, upb_current from @panel where reporting_period = date '1999-06-01'""")
def p20(spark, sf):
    return tables.monthly(spark, sf).filter(
        F.col("reporting_period") == F.lit("1999-06-01").cast("date")).select(
        "loan_id", "delq_status", "upb_current")


@query("p21_drop_nulls", """
select vintage, count(*) as n from @panel where total_principal_current is not null
  and delq_status is not null group by vintage""")
def p21(spark, sf):
    return (tables.monthly(spark, sf).na.drop(subset=["total_principal_current", "delq_status"])
            .groupBy("vintage").agg(F.count(F.lit(1)).alias("n")))


@query("p22_median_impute", """
select vintage, round(sum(coalesce(total_principal_current,
    (select median(total_principal_current) from @panel))), 2) as principal,
  round(sum(coalesce(balance_change_3m, (select median(balance_change_3m) from @feat))), 6) as change
from @feat group by vintage""")
def p22(spark, sf):
    rows = feat(spark, sf).withColumn("nothing", F.lit(None).cast("double"))
    filled, kept = regression.impute_medians(
        rows, ["total_principal_current", "balance_change_3m", "nothing"])
    assert "nothing" not in kept
    return filled.groupBy("vintage").agg(
        F.round(F.sum("total_principal_current"), 2).alias("principal"),
        F.round(F.sum("balance_change_3m"), 6).alias("change"))


@query("p23_row_extremes", """
select loan_id, greatest(fico_orig / 10, ltv_orig, dti_orig) as highest,
  least(fico_orig / 10, ltv_orig, dti_orig) as lowest from @loans""")
def p23(spark, sf):
    three = [F.col("fico_orig") / 10, F.col("ltv_orig"), F.col("dti_orig")]
    return tables.loans(spark, sf).select("loan_id", F.greatest(*three).alias("highest"),
                                          F.least(*three).alias("lowest"))


@query("p24_report_rounding", """
select stage, count(*) as n, round(100 * count(*) / (select count(*) from @staged), 2) as pct
from @staged group by stage""")
def p24(spark, sf):
    return staging.stage_distribution(staged(spark, sf))


# ---- joins ---------------------------------------------------------------------------------


@query("j1_panel_assembly", """
select state, count(*) as n, round(sum(upb_current / upb_orig), 4) as share from @panel
where vintage in ('1996Q1', '1998Q3') group by state""")
def j1(spark, sf):
    rows = features.loan_month_panel(tables.monthly(spark, sf), tables.master(spark, sf),
                                     ["1996Q1", "1998Q3"])
    return rows.groupBy("state").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("upb_current") / F.col("upb_orig")), 4).alias("share"))


@query("j2_dispositions", """
select loan_id, default_period, upb_current, ltv_orig, state,
  round(foreclosure_costs, 4) as foreclosure_costs from @events_lgd""")
def j2(spark, sf):
    return severity.dispositions(
        tables.monthly_with_amounts(spark, sf), tables.master(spark, sf)).select(
        "loan_id", "default_period", "upb_current", "ltv_orig", "state",
        F.round("foreclosure_costs", 4).alias("foreclosure_costs"))


@query("j3_macro_join", """
select reporting_period, count(*) as n, count(unemployment) as known,
  round(sum(hpi), 3) as hpi from @panel left join @macro using (reporting_period) group by 1""")
def j3(spark, sf):
    rows = features.with_macro(tables.monthly(spark, sf), macro_table(spark, sf))
    rows = features.with_macro(rows, None)
    return rows.groupBy("reporting_period").agg(
        F.count(F.lit(1)).alias("n"), F.count("unemployment").alias("known"),
        F.round(F.sum("hpi"), 3).alias("hpi"))


@query("j4_macro_columns", """
select reporting_period, count(mortgage_30y) as known, round(sum(treasury_10y), 3) as treasury_10y
from @panel left join @macro using (reporting_period) group by 1""")
def j4(spark, sf):
    rows = features.with_macro(tables.monthly(spark, sf), macro_table(spark, sf),
                               ["treasury_10y", "mortgage_30y"])
    return rows.groupBy("reporting_period").agg(
        F.count("mortgage_30y").alias("known"),
        F.round(F.sum("treasury_10y"), 3).alias("treasury_10y"))


@query("j5_terminal_join", """
select vintage, count(*) as n, count(prepay_period) as prepaid, count(default_period) as defaulted
from @panel left join @terminal using (loan_id) group by vintage""")
def j5(spark, sf):
    monthly = tables.monthly(spark, sf)
    return monthly.join(labels.terminal_events(monthly), "loan_id", "left").groupBy("vintage").agg(
        F.count(F.lit(1)).alias("n"), F.count("prepay_period").alias("prepaid"),
        F.count("default_period").alias("defaulted"))


RATES_SQL = """select reporting_period, avg(target) as dr, count(*) as n from @closed
  group by 1 having count(*) >= 500"""


@query("j6_rates_with_macro", f"""
select reporting_period, dr, n, round(hpi_yoy, 6) as hpi_yoy from ({RATES_SQL})
join @macro using (reporting_period) where hpi_yoy is not null and gdp_yoy is not null""")
def j6(spark, sf):
    rates = labels.default_rate_by_period(closed(spark, sf))
    return rates.join(macro_table(spark, sf), "reporting_period").na.drop(
        subset=["hpi_yoy", "gdp_yoy"]).select(
        "reporting_period", "dr", "n", F.round("hpi_yoy", 6).alias("hpi_yoy"))


@query("j7_series_report", f"""
select reporting_period, dr, n, round(unemployment, 6) as unemployment from ({RATES_SQL})
left join @macro using (reporting_period)""")
def j7(spark, sf):
    rates = labels.default_rate_by_period(closed(spark, sf))
    return features.with_macro(rates, macro_table(spark, sf), ["unemployment"]).select(
        "reporting_period", "dr", "n", F.round("unemployment", 6).alias("unemployment"))


@query("j8_origination_fallback", "select loan_id, pd_orig, pd_now from @snapshot")
def j8(spark, sf):
    return snapshot(spark, sf).select("loan_id", "pd_orig", "pd_now")


@query("j9_snapshot_self_join", f"""
with a as (select loan_id, case when delq_num >= 3 then 3 when delq_num >= 1 then 2 else 1 end as s
           from @feat where reporting_period = date '1999-06-01'),
b as (select loan_id, case when delq_num >= 3 then 3 when delq_num >= 1 then 2 else 1 end as s
      from @feat where reporting_period = date '1999-12-01')
select a.s as stage_from, b.s as stage_to, count(*) as n from a join b using (loan_id) group by 1, 2""")
def j9(spark, sf):
    def at(day):
        rows = feat(spark, sf).filter(F.col("reporting_period") == F.lit(day).cast("date"))
        late = F.col("delq_num")
        return rows.select("loan_id", F.when(late >= 3, 3).when(late >= 1, 2).otherwise(1)
                           .alias("stage"))
    return staging.migration_matrix(at("1999-06-01"), at("1999-12-01"))


@query("j10_exposure_join", """
select stage, count(*) as n, round(sum(upb), 0) as upb, sum(term) as term from @book group by stage""")
def j10(spark, sf):
    from workload.common import book

    return book(spark, sf).groupBy("stage").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("upb"), 0).alias("upb"),
        F.sum("term").alias("term"))


@query("j11_double_lookup", """
select loan_id, round(mtm_ltv, 6) as mtm_ltv, loan_age_years from @lgd""")
def j11(spark, sf):
    rows = severity.with_current_ltv(losses(spark, sf), macro_table(spark, sf))
    return rows.select("loan_id", F.round("mtm_ltv", 6).alias("mtm_ltv"), "loan_age_years")


@query("j13_consecutive_periods", """
select lag(q) over (order by q) as q_from, q as q_to, n, lag(n) over (order by q) as n_before
from (select cast(date_trunc('quarter', reporting_period) as date) as q, count(*) as n
      from @panel group by 1) qualify lag(q) over (order by q) is not null""")
def j13(spark, sf):
    from pyspark.sql import Window as W

    quarters = tables.monthly(spark, sf).groupBy(
        dates.quarter_start("reporting_period").alias("q_to")).agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy().orderBy("q_to")  # one row per quarter
    return quarters.select(F.lag("q_to").over(order).alias("q_from"), "q_to", "n",
                           F.lag("n").over(order).alias("n_before")).filter(
        F.col("q_from").isNotNull())
