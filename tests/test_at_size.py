"""What grows with the tables is neither broadcast, copied nor read without need."""

import gzip

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_salted_copies_are_not_broadcast(spark, monkeypatch):
    """Spark took 32 copies of a table for as large as the table, and broadcast them."""
    from lossloom.llm import storage

    monkeypatch.setattr(storage, "SMALL_ROWS", 10)
    left = storage.stored(spark.range(400).selectExpr("cast(id % 30 as string) as k", "id"))
    right = storage.stored(spark.range(20).selectExpr("cast(id as string) as k", "id * 2 as v"))
    met = storage.join_on_hot_key(left, right, "k", "id")
    assert "BroadcastHashJoin" not in plan(met)
    assert {(r.id, r.v) for r in met.collect()} == {
        (i, i % 30 * 2 if i % 30 < 20 else None) for i in range(400)} and met.count() == 400


def test_words_are_not_broadcast(spark):
    """Packed files under the limit of Spark held words that were not."""
    from lossloom.llm import spelling
    from lossloom.llm.storage import stored

    words = stored(spark.createDataFrame([("aaaaa", 9), ("aaaab", 4), ("bbbbb", 3)], "word string, n long"))
    rows = spelling.forms(words, spelling.near_pairs(words))
    assert "BroadcastHashJoin" not in plan(rows)
    roots = spelling.with_roots(stored(rows))
    assert "BroadcastHashJoin" not in plan(roots)
    assert {(r.word, r.root) for r in roots.collect()} == {
        ("aaaaa", "aaaaa"), ("aaaab", "aaaaa"), ("bbbbb", "bbbbb")}


def test_a_batch_is_merged_without_a_copy(spark, tmp_path, monkeypatch):
    """The batch was cached, and shuffled before its rows met the old ones."""
    from lossloom.sources.versions import VersionedWarehouse
    from lossloom.streaming import corrections

    calls, plain = [], corrections.newest_rows
    monkeypatch.setattr(corrections, "newest_rows", lambda *a, **k: calls.append(1) or plain(*a, **k))
    kept = []
    rows = spark.createDataFrame([(1, 1, 1, 5.0, "2018Q1"), (1, 1, 3, 6.0, "2018Q1"), (2, 1, 2, 7.0, "2018Q1")],
                                 "loan_id long, reporting_period int, version int, upb double, vintage string")
    monkeypatch.setattr(type(rows), "persist", lambda df, *a, **k: kept.append(1) or df)
    store = VersionedWarehouse(spark, str(tmp_path))
    for batch in (rows, rows.withColumn("upb", F.lit(1.0)).withColumn("version", F.lit(2))):
        corrections.merge_corrections(store, batch, "t", 2)
    assert not kept and len(calls) == 2
    assert sorted((r.loan_id, r.version, r.upb) for r in store.read("t").collect()) == [(1, 3, 6.0), (2, 2, 7.0)]


def test_replaced_parts_are_deleted(spark, monkeypatch):
    """Every load of the corrections stayed on disk."""
    import os

    from workload import q_data
    from workload.catalog import QUERIES

    roots, plain = [], q_data.scratch
    monkeypatch.setattr(q_data, "scratch", lambda s: roots.append(plain(s)) or roots[-1])
    assert QUERIES["i1_row_corrections"](spark, SF).count() > 0
    assert len(os.listdir(f"{roots[0].removeprefix('file:')}/wh/data/rows")) == 1


def test_widths_need_the_first_lines_only(spark, tmp_path):
    """A job decompressed and measured every line of every file."""
    from lossloom.sources import raw_files

    (tmp_path / "Performance_2018Q1.csv").write_text("a|b|c\r\n1|2\n")
    (tmp_path / "Performance_2018Q2.csv").write_text("")
    (tmp_path / "Performance_2018Q3.csv").write_text("\n1|2\n")
    with gzip.open(tmp_path / "Performance_2018 Q4.csv.gz", "wt") as f:
        f.write("é|b\n1|2|3|4\n")
    sc = spark.sparkContext
    sc.setJobGroup("widths", "widths")
    widths = raw_files.first_line_widths(spark, [str(f) for f in sorted(tmp_path.iterdir())])
    jobs = sc.statusTracker().getJobIdsForGroup("widths")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs and widths == {
        "Performance_2018Q1.csv": 3, "Performance_2018Q3.csv": 1, "Performance_2018 Q4.csv.gz": 2}


def test_monitoring_stores_its_panel_once(spark, monkeypatch):
    """The labelled rows were stored, and the scored ones again."""
    from workload.catalog import QUERIES

    probe, stored = spark.range(1), []
    plain = type(probe).checkpoint
    monkeypatch.setattr(type(probe), "checkpoint",
                        lambda df, *a, **k: stored.append(set(df.columns)) or plain(df, *a, **k))
    QUERIES["v14_monitoring_run"](spark, SF).collect()
    assert not any(s & {"count_30dpd_12m", "pred_pd"} for s in stored)


def test_few_conditions_place_a_value(spark):
    """Each of 11 intervals was compared four times in one method, too long to be compiled."""
    from lossloom.operators import ranks

    probs = [i / 10 for i in range(11)]
    rows = spark.range(40_000).selectExpr("id % 3 as g", "pmod(hash(id), 10007) / 7e0 as x")
    counts = ranks.compact_counts(rows, ["g"], "x", probs)
    text = counts._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("_q#") < 60
    assert {r.g: r.n for r in counts.groupBy("g").agg(F.sum("n").alias("n")).collect()} == {
        0: 13334, 1: 13333, 2: 13333}
    found = {r.g: r.quantiles for r in ranks.exact_quantiles(rows, ["g"], "x", probs).collect()}
    for r in rows.groupBy("g").agg(F.percentile("x", probs).alias("q")).collect():
        assert all(abs(a - b) < 1e-9 for a, b in zip(found[r.g], r.q, strict=True))
