from pyspark.sql import functions as F

from lossloom.operators import drift, quality, ranks
from lossloom.schema import CHECK_RESULT


def one(df):
    return df.collect()[0]


def test_duplicates_fail(spark):
    df = spark.createDataFrame([("A",), ("B",), ("B",)], "loan_id string")
    row = one(quality.duplicate_check(df, "t", ["loan_id"]))
    assert row["status"] == "FAIL" and row["value"] == 1.0


def test_one_pass_checks(spark):
    df = spark.createDataFrame([(100.0, 700.0, None), (-5.0, 200.0, None), (50.0, 800.0, "x")],
                               "upb double, fico double, note string")
    rows = {(r["check_type"], r["column"]): r for r in
            quality.Checks("t").non_negative(df, ("upb",)).ranges(df, {"fico": (300, 850)})
            .completeness(df, ("upb", "note", "gone"), 5.0).schema(df, ["upb", "x"])
            .run(df).collect()}
    assert rows["non_negative", "upb"]["value"] == 1.0
    assert rows["range", "fico"]["status"] == "WARN"
    assert rows["completeness", "upb"]["status"] == "PASS"
    assert rows["completeness", "note"]["value"] == 66.6667
    assert rows["completeness", "gone"]["status"] == "FAIL"


def test_coverage_gap(spark):
    df = spark.createDataFrame([("2018Q1",), ("2018Q3",), (None,)], "vintage string")
    row = one(drift.coverage_check(df))
    assert row["status"] == "WARN" and "2018Q2" in row["message"]


def test_psi_is_zero_for_equal_and_null_for_thin(spark):
    rows = [(p, "f", float(i % 100)) for p in ("a", "b") for i in range(500)]
    rows += [("c", "f", 1.0)] * 5 + [("d", "f", None)] * 30
    psi = {r["to"]: r["psi"] for r in drift.stability(
        spark.createDataFrame(rows, "period string, feature string, x double"), "period").collect()}
    assert abs(psi["b"]) < 1e-9 and psi["c"] is None and psi["d"] is None and len(psi) == 3


def test_scorecard_counts_warn_as_half(spark):
    rows = [("t", "x", None, "m", 0.0, 0.0, s, "") for s in ("PASS", "FAIL", "WARN", "INFO")]
    card = quality.scorecard(spark.createDataFrame(rows, CHECK_RESULT))
    overall = card.filter("is_overall = 1").first()
    assert overall["score"] == 50.0 and overall["grade"] == "F" and overall["n_info"] == 1


def test_outliers(spark):
    df = spark.range(100).select(F.when(F.col("id") == 0, 1e6).otherwise(F.col("id")).alias("v"))
    row = one(quality.outlier_check(df, "t", ["v", "missing"]))
    assert row["value"] == 1.0 and row["status"] == "INFO"


def test_nearest_quartiles_take_a_value(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 10, 20, 40)], "v double")
    got = [ranks.exact_quantiles(quality.long_values(df, ["v"]), ["feature"], "x", [.1, .25, .5, .75],
                                 interpolation=i).first()["quantiles"] for i in ("linear", "nearest")]
    assert got[0] == [.5, 1.25, 6.0, 17.5] and got[1] == [1.0, 1.0, 10.0, 20.0]


def test_checks_while_storing_read_the_rows_once(spark, tmp_path):
    """An accumulator counts how often rows are derived; figures equal those of a scan."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    plain = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "loan_id long, upb double")
    rows = plain.mapInPandas(count, plain.schema)
    checks = quality.Checks("t").completeness(plain, ("upb",), 5.0).non_negative(plain, ("upb",))
    kept, got = checks.while_storing(rows)
    kept.write.parquet(str(tmp_path / "t"))
    assert sorted(map(str, got.collect())) == sorted(map(str, checks.run(plain).collect()))
    assert seen.value == 3 and spark.read.parquet(str(tmp_path / "t")).count() == 3
    few, got = checks.while_storing(plain, ["loan_id"])
    assert few.columns == ["loan_id"] and few.count() == 3
    assert sorted(map(str, got.collect())) == sorted(map(str, checks.run(plain).collect()))


def test_unknown_quarters_are_named(spark):
    df = spark.createDataFrame([("2018Q1",), ("1995Q3",), ("1995Q3",)], "vintage string")
    assert "2 loan(s) without a known quarter" in one(drift.coverage_check(df))["message"]
