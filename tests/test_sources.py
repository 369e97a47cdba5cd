from datetime import date

import pytest
from pyspark.sql import functions as F

from lossloom import schema
from lossloom.plans.ingest import ingest
from lossloom.sources import feature_store, raw_files, results, warehouse
from lossloom.sources.versions import VersionedWarehouse
from lossloom.streaming.vintages import start_ingest


def line(loan, month, width=108, **fields):
    names = schema.raw_field_names(width)
    values = {"loan_id": loan, "reporting_period": month, "upb_current": "1000.5", "delq_status": "00",
              "fico_orig": "700", "origination_date": "012018", **fields}
    return "|".join(values.get(n, "") for n in names)


@pytest.fixture
def folder(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "Performance_2018Q1.csv").write_text("\n".join(
        [line("A", "032018"), line("A", "022018", fico_orig="690"), line("B", "022018", upb_current="n/a")]) + "\n")
    (raw / "2018-Q2.TXT").write_text(line("C", "13x018", width=110, extra_field_109="x") + "\n")
    (raw / "2018Q3.csv").write_text("only|three|fields\n")
    (raw / "2018Q4.zip").write_text("no")
    (raw / "notes.csv").write_text("no")
    return raw


def test_layout():
    kinds = [f.kind for f in schema.FIELDS]
    assert (len(kinds), kinds.count("num"), kinds.count("date")) == (108, 54, 16)
    assert len(schema.LOAN_MASTER) == 28 and len(schema.LOAN_MONTHLY) == 41
    assert schema.column_name("Original Loan to Value Ratio (LTV)") == "ltv_orig"
    assert schema.column_name("ARM Initial Fixed-Rate Period <= 5 YR Indicator") == \
        "arm_initial_fixed_rate_period_5_yr_indicator"
    assert schema.raw_field_names(110)[-1] == "extra_field_110"
    with pytest.raises(ValueError):
        schema.raw_field_names(107)


def test_ingest_is_incremental_and_repeatable(spark, folder, tmp_path):
    root = str(tmp_path / "wh")
    first = {r["vintage"]: r for r in ingest(spark, str(folder), root).collect()}
    assert {v: r["status"] for v, r in first.items()} == {
        "2018Q1": "SUCCESS", "2018Q2": "SUCCESS", "2018Q3": "FAILED"}
    assert (first["2018Q1"]["rows_master"], first["2018Q1"]["rows_monthly"]) == (2, 3)
    assert "3 fields" in first["2018Q3"]["message"]
    store = VersionedWarehouse(spark, root)
    monthly = store.read("loan_monthly")
    assert monthly.filter("vintage = '2018Q2'").first()["reporting_period"] is None
    assert monthly.filter("loan_id = 'B'").first()["upb_current"] is None
    assert monthly.filter("loan_id = 'A'").agg(F.max("reporting_period")).first()[0] == date(2018, 3, 1)
    assert store.read("loan_master").filter("loan_id = 'A'").first()["fico_orig"] == 690.0
    again = ingest(spark, str(folder), root)
    assert [r["vintage"] for r in again.collect()] == ["2018Q3"]
    (folder / "2018Q3.csv").write_text(line("D", "082018") + "\n")
    assert [r["status"] for r in ingest(spark, str(folder), root).collect()] == ["SUCCESS"]
    ingest(spark, str(folder), root, force=True)
    assert store.read("loan_monthly").count() == 5 and store.read("loan_master").count() == 4
    assert store.read("metadata_catalog").count() == 64


def test_stream_keeps_all_files_of_a_quarter(spark, folder, tmp_path):
    (folder / "notes.csv").unlink()
    (folder / "2018Q4.zip").unlink()
    root, checkpoint = str(tmp_path / "wh"), str(tmp_path / "cp")
    store = VersionedWarehouse(spark, root)

    def rows(table):
        return {r["vintage"]: r["count"] for r in store.read(table).groupBy("vintage").count().collect()}

    start_ingest(spark, str(folder), root, checkpoint).awaitTermination(120)
    assert rows("loan_monthly") == {"2018Q1": 3, "2018Q2": 1}
    (folder / "Performance_2018Q1_part2.csv").write_text(
        "\n".join(line(x, "022018") for x in "EFG") + "\n")
    (folder / "2018Q2_b.csv").write_text(line("H", "052018") + "\n")
    start_ingest(spark, str(folder), root, checkpoint, max_files=1).awaitTermination(120)
    assert rows("loan_monthly") == {"2018Q1": 6, "2018Q2": 2}
    assert rows("loan_master") == {"2018Q1": 5, "2018Q2": 2}
    log = store.read("ingestion_log")
    assert {r["vintage"] for r in log.filter("status = 'FAILED'").collect()} == {"2018Q3"}
    newest = log.filter("vintage = '2018Q1'").orderBy(F.desc("finished_at")).first()
    assert (newest["rows_master"], newest["rows_monthly"]) == (5, 6)
    start_ingest(spark, str(folder), root, checkpoint).awaitTermination(120)
    assert rows("loan_monthly") == {"2018Q1": 6, "2018Q2": 2}


def test_first_line_widths_come_from_one_job(spark, folder):
    (folder / "empty_2019Q1.csv").write_text("")
    paths = [r["path"] for r in raw_files.list_files(spark, str(folder)).collect()]
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    assert raw_files.first_line_widths(spark, paths) == {
        "Performance_2018Q1.csv": 108, "2018-Q2.TXT": 110, "2018Q3.csv": 3}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - len(before) <= 3
    assert raw_files.first_line_widths(spark, []) == {}


def test_failed_quarters_are_tried_again(spark):
    log = spark.createDataFrame([("2018Q1", "SUCCESS"), ("2018Q2", "FAILED")], "vintage string, status string")
    files = spark.createDataFrame([("2018Q1",), ("2018Q2",), ("2018Q3",)], "vintage string")
    todo = warehouse.not_yet_ingested(files, log)
    assert sorted(r["vintage"] for r in todo.collect()) == ["2018Q2", "2018Q3"]
    assert warehouse.not_yet_ingested(files, log, force=True).count() == 3


def test_bucketed_table_joins_without_shuffle(spark, tmp_path):
    store = warehouse.Warehouse(spark, str(tmp_path))
    rows = spark.range(1000).select((F.col("id") % 50).alias("loan_id"), F.col("id").alias("reporting_period"))
    spark.sql("drop table if exists bucketed_rows")
    store.save_bucketed(rows, "bucketed_rows", 4)
    plan = spark.table("bucketed_rows").groupBy("loan_id").count()._jdf.queryExecution().executedPlan().toString()
    spark.sql("drop table bucketed_rows")
    assert "Exchange hashpartitioning" not in plan


def test_feature_store(spark, tmp_path):
    store = warehouse.Warehouse(spark, str(tmp_path))
    rows = spark.createDataFrame([("A", date(2018, 1, 1), 1.0, "2018Q1"), ("B", date(2018, 4, 1), 2.0, "2018Q2")],
                                 "loan_id string, reporting_period date, x double, vintage string")
    feature_store.write(store, rows)
    feature_store.write(store, rows.filter("loan_id = 'B'").withColumn("x", F.lit(9.0)))
    got = {r["loan_id"]: r["x"] for r in feature_store.scan(store).collect()}
    assert got == {"A": 1.0, "B": 9.0}


# ---- result views --------------------------------------------------------------------------


def test_views_degrade_without_tables(spark, tmp_path):
    store = results.Results(spark, str(tmp_path))
    assert store.get("ecl_summary") is None
    row = results.overview(spark).first()
    assert row["total_ecl"] is None and row["monitoring_status"] is None and row["stage_distribution"] == []
    assert results.loss_view(spark, None) is None and results.monitoring_view(spark, None) is None
    row = results.model_view(spark).first()
    assert row["pd_auc"] is None and row["pd_roc"] == [] and row["lgd_window"] is None


def test_views_read_saved_tables(spark, tmp_path):
    store = results.Results(spark, str(tmp_path))
    ecl = spark.createDataFrame(
        [(1, 10, 100.0, 1.0, 1.0, 2.0, 1.0), (None, 10, 100.0, 1.0, 1.0, 2.0, 1.0)],
        "stage int, n_loans bigint, ead double, ecl double, ecl_12m double, ecl_lifetime double, coverage_pct double")
    store.replace(ecl, "ecl_summary")
    row = results.overview(spark, store.get("ecl_summary")).first()
    assert row["total_ecl"] == 1.0 and row["n_loans"] == 10
    assert len(results.loss_view(spark, store.get("ecl_summary")).first()["by_stage"]) == 1
    legacy = spark.createDataFrame([("AMBER",)], "overall_status string")
    assert results.monitoring_view(spark, legacy).first()["latest_status"] == "AMBER"
    window = spark.createDataFrame([(date(2014, 12, 1), date(2016, 11, 1))], "window_start date, window_end date")
    metrics = spark.createDataFrame([("a", .91, .82, .66), ("b", .9, .8, .64)],
                                    "model string, auc double, gini double, ks double")
    row = results.model_view(spark, metrics=metrics, window=window).first()
    assert row["pd_best_model"] == "a" and row["lgd_window"] == "2014-12 – 2016-11" and len(row["pd_models"]) == 2
