"""Files of different schemas as one table."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as t

from lossloom.sources.united import read_united, supertype, united_schema


@pytest.mark.parametrize("a, b, want", [
    (t.IntegerType(), t.LongType(), t.LongType()), (t.IntegerType(), t.DoubleType(), t.DoubleType()),
    (t.IntegerType(), t.FloatType(), t.DoubleType()), (t.ShortType(), t.FloatType(), t.FloatType()),
    (t.BooleanType(), t.IntegerType(), t.IntegerType()), (t.DateType(), t.TimestampType(), t.TimestampType()),
    (t.DecimalType(10, 2), t.LongType(), t.DecimalType(21, 2)), (t.NullType(), t.DateType(), t.DateType()),
    (t.DecimalType(38, 0), t.DecimalType(38, 18), t.DoubleType()), (t.StringType(), t.LongType(), t.StringType()),
    (t.DecimalType(9, 2), t.DoubleType(), t.DoubleType())])
def test_common_types(a, b, want):
    assert supertype(a, b) == supertype(b, a) == want


def test_no_common_type_names_the_column():
    one, two = (t.StructType([t.StructField("x", k)]) for k in (t.DateType(), t.LongType()))
    with pytest.raises(TypeError, match="column x"):
        united_schema([one, two])


def test_no_value_turns_to_null(spark, tmp_path):
    frames = {
        "ints": ([(1, 2_000_000_000, date(2018, 1, 1), Decimal("1.25"), 7)],
                 "k int, v int, d date, m decimal(9,2), s long"),
        "fractions": ([(2, 0.5, datetime(2018, 1, 1, 5), Decimal("123456789012.5"), "seven")],
                      "k long, v double, d timestamp, m decimal(20,1), s string"),
        "fewer": ([(3,)], "k short"), "more": ([(4, 1.5, True)], "k int, v float, extra boolean")}
    for name, (rows, kind) in frames.items():
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}")
    df = read_united(spark, [f"{tmp_path}/{n}" for n in frames])
    assert df.dtypes == [("k", "bigint"), ("v", "double"), ("d", "timestamp"), ("m", "decimal(21,2)"),
                         ("s", "string"), ("extra", "boolean")]
    rows = {r.k: r for r in df.collect()}
    assert (rows[1].v, rows[1].d, rows[1].m, rows[1].s) == (2e9, datetime(2018, 1, 1), Decimal("1.25"), "7")
    assert (rows[2].v, rows[2].m, rows[2].s) == (.5, Decimal("123456789012.50"), "seven")
    assert rows[3][1:] == (None,) * 5 and (rows[4].v, rows[4].extra) == (1.5, True)


def test_one_scan_per_schema(spark, tmp_path):
    for i in range(6):
        spark.createDataFrame([(i, float(i))], f"k {'int' if i % 2 else 'long'}, v double").write.parquet(
            f"{tmp_path}/{i}")
    df = read_united(spark, [f"{tmp_path}/{i}" for i in range(6)])
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    assert sorted(r.k for r in df.collect()) == list(range(6))
