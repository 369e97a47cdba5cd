"""The registered raw scan and ingest queries go through files."""

import pytest

from lossloom.sources import raw_files, warehouse
from workload import tables
from workload.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["s3_raw_scan", "s4_positional_names", "s17_ingest"])
def test_files_are_listed_and_read(spark, monkeypatch, name):
    seen = []
    plain = raw_files.list_files
    monkeypatch.setattr(raw_files, "list_files", lambda *a, **k: seen.append(a) or plain(*a, **k))
    monkeypatch.setattr("lossloom.plans.ingest.list_files", raw_files.list_files, raising=False)
    rows = QUERIES[name](spark, SF).collect()
    assert seen
    panel = tables.full_panel(spark, SF)
    column = "rows_monthly" if name == "s17_ingest" else "n"
    assert sum(r[column] for r in rows) == panel.count()
    if name != "s4_positional_names":
        assert len(rows) == panel.select("vintage").distinct().count()


def test_parsed_lines_are_registered():
    assert "s3_parsed_lines" in QUERIES


def test_files_that_are_passed_over_are_named(spark, tmp_path):
    for name in ("Performance_2018Q1.csv", "Performance_1995Q2.csv", "notes.csv", "2018Q2.zip"):
        (tmp_path / name).write_text("x")
    assert [r.file for r in raw_files.list_files(spark, str(tmp_path)).collect()] == [
        "Performance_2018Q1.csv"]
    out = {r.file: r.reason for r in raw_files.left_out_files(spark, str(tmp_path)).collect()}
    assert out == {"Performance_1995Q2.csv": "no quarter in the name",
                   "notes.csv": "no quarter in the name", "2018Q2.zip": "not a data file"}


def test_audit_message_is_cut_to_its_field(spark):
    counts = spark.createDataFrame([("2018Q1", "a.csv", 1, 2)],
                                   "vintage string, source_file string, rows_master int, "
                                   "rows_monthly int")
    row = warehouse.log_rows(counts, "FAILED", 1.0, "x" * 880).first()
    assert row.message == "x" * 500


def test_raw_files_are_small_and_lines_are_not_shuffled(spark, tmp_path):
    """Written as plain text the months took about 180 bytes each, and were shuffled as lines."""
    import os

    from workload import q_data

    folder = q_data.raw_folder(spark, SF)
    paths = q_data.raw_paths(spark, folder)
    rows = raw_files.read_raw(spark, paths)
    n = tables.full_panel(spark, SF).count()
    assert rows.count() == n
    size = sum(os.path.getsize(p.removeprefix("file:")) for p in paths)
    assert size < 60 * n
    per_file = rows.groupBy("vintage").count().count()
    assert len(paths) <= per_file + int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_packed_files_are_ingested_if_named(spark, tmp_path):
    import gzip

    from lossloom import schema
    from lossloom.plans.ingest import ingest
    from lossloom.sources.versions import VersionedWarehouse

    (tmp_path / "raw").mkdir()
    names = schema.raw_field_names(108)
    for quarter in ("2018Q1", "2018Q2"):
        with gzip.open(tmp_path / "raw" / f"Performance_{quarter}.csv.gz", "wt") as f:
            for loan in "AB":
                f.write("|".join({"loan_id": loan, "reporting_period": "032018"}.get(c, "")
                                 for c in names) + "\n")
    folder, root = str(tmp_path / "raw"), str(tmp_path / "wh")
    assert raw_files.list_files(spark, folder).isEmpty()
    audit = ingest(spark, folder, root, extensions=(".gz",)).collect()
    assert {r["vintage"]: (r["status"], r["rows_monthly"]) for r in audit} == {
        "2018Q1": ("SUCCESS", 2), "2018Q2": ("SUCCESS", 2)}
    assert VersionedWarehouse(spark, root).read("loan_monthly").count() == 4


def test_versions_arrive_in_many_files_and_one_batch(spark, monkeypatch):
    """Each version used to be one file, written by one task."""
    import os

    from lossloom.streaming import corrections

    seen, plain = [], corrections.start_corrections

    def watched(spark, folder, root, *a, **k):
        seen.append(sum(f.endswith(".parquet") for f in os.listdir(folder.removeprefix("file:"))))
        return plain(spark, folder, root, *a, **k)

    monkeypatch.setattr(corrections, "start_corrections", watched)
    rows = QUERIES["i1_row_corrections"](spark, SF).collect()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert seen == [parts, 2 * parts, 3 * parts, 3 * parts, 3 * parts]
    assert sum(r["n"] for r in rows) == tables.full_panel(spark, SF).count()
