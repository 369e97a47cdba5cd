"""The feature store computes the features once per write, where the loans were placed."""

from datetime import datetime

import pytest

from lossloom.operators import features
from lossloom.sources import feature_store, warehouse
from workload import q_data, tables


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Loan 43 has an early and a late order, 86 no order date; one order has no key."""
    root = str(tmp_path_factory.mktemp("placed"))
    days = [datetime(1995 + i % 4, 1 + i % 12, 5) for i in range(60)]
    orders = [(100 + i, i % 3, 1000.0 + i, d) for i, d in enumerate(days)]
    orders += [(43, 0, 500.0, datetime(1996, 11, 3)), (43, 1, 700.0, datetime(1998, 1, 3)),
               (86, 1, 800.0, None), (None, 1, 900.0, datetime(1996, 1, 3))]
    for name, rows, kind in (
            ("orders", orders, "o_orderkey bigint, o_custkey bigint, o_totalprice double, "
                               "o_orderdate timestamp_ntz"),
            ("customer", [(i, i) for i in range(3)], "c_custkey bigint, c_nationkey int"),
            ("nation", [(i, f"N{i}") for i in range(3)], "n_nationkey int, n_name string")):
        spark.createDataFrame(rows, kind).write.parquet(f"{root}/{name}.parquet")
    return root


def by_text(rows):
    return sorted(map(str, rows))


def test_rows_of_both_steps_are_those_of_the_loan_windows(spark, folder, tmp_path, monkeypatch):
    first, plain = [], feature_store.reset

    def kept(store, rows):
        plain(store, rows)
        first.extend(feature_store.scan(store).collect())

    monkeypatch.setattr(feature_store, "reset", kept)
    monkeypatch.setattr(q_data, "scratch", lambda spark: str(tmp_path))
    digests = q_data.s13(spark, folder).collect()
    want = features.with_features(tables.full_panel(spark, folder))
    stored = feature_store.scan(warehouse.Warehouse(spark, str(tmp_path)))
    assert sorted(stored.columns) == sorted(want.columns)
    assert by_text(stored.select(want.columns).collect()) == by_text(want.collect())
    early = want.filter("vintage < '1997'")
    assert early.filter("loan_id = 43").count() == 6
    at = [stored.columns.index(c) for c in want.columns]
    assert sorted(str(tuple(r[i] for i in at)) for r in first) == sorted(
        str(tuple(r)) for r in early.collect())
    assert sum(r["n"] for r in digests) == want.count()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_feature_rows_are_neither_sampled_nor_shuffled(spark, folder, tmp_path, monkeypatch):
    """The range sample computed all features once more, then every feature row was shuffled."""
    ranged, seen, frame = [], [], type(spark.range(1))
    plain, replace = frame.repartitionByRange, warehouse.Warehouse.replace_vintages

    def counted(df, *a):
        ranged.append(set(df.columns))
        return plain(df, *a)

    def planned(store, df, table):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        replace(store, df, table)

    monkeypatch.setattr(frame, "repartitionByRange", counted)
    monkeypatch.setattr(warehouse.Warehouse, "replace_vintages", planned)
    monkeypatch.setattr(q_data, "scratch", lambda spark: str(tmp_path))
    q_data.s13(spark, folder)
    assert ranged and all("max_delq_12m" not in columns for columns in ranged)
    above = seen[0][:seen[0].index("Generate explode")]
    assert "Window" in above and "Exchange" not in above and above.count("Sort [") == 1


def test_late_loans_are_left_out_of_the_early_windows(spark, folder, tmp_path, monkeypatch):
    """The windows ran over all loans, and the early vintages were picked afterwards."""
    seen = []
    monkeypatch.setattr(feature_store, "reset", lambda store, rows: seen.append(rows))
    monkeypatch.setattr(q_data, "scratch", lambda spark: str(tmp_path))
    q_data.s13(spark, folder)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "< 1997" in plan[plan.index("Generate explode"):]


def test_many_loans_get_more_parts(spark, monkeypatch):
    monkeypatch.setattr(feature_store, "LOANS_PER_PART", 10)
    loans = spark.range(200).selectExpr("id as loan_id", "concat('199', id % 5, 'Q1') as vintage")
    placed = feature_store.place_loans(loans)
    assert placed.rdd.getNumPartitions() == 20
    assert placed.count() == 200


def test_placed_vintages_are_replaced(spark, tmp_path):
    store = warehouse.Warehouse(spark, str(tmp_path))
    loans = spark.createDataFrame([("A", "2018Q1", 1.0), ("B", "2018Q2", 2.0), (None, "2018Q1", 3.0)],
                                  "loan_id string, vintage string, x double")
    feature_store.reset(store, feature_store.place_loans(loans))
    feature_store.write(store, feature_store.place_loans(loans.filter("x = 2").withColumn("x", loans.x * 4)))
    got = {r["loan_id"]: r["x"] for r in feature_store.scan(store).collect()}
    assert got == {"A": 1.0, "B": 8.0} and feature_store.HOME not in feature_store.scan(store).columns
