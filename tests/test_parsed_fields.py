"""Raw fields and months: only what is asked for is made, with the same values."""

import pytest
from pyspark.sql import functions as F

from lossloom import schema
from lossloom.functions.dates import parse_month
from lossloom.sources import raw_files

NAMES = schema.raw_field_names(108)
LINES = ["|".join(str(i) for i in range(n)) for n in (1, 3, 12, 13, 108, 110)] + [
    "", "|" * 107, "|" * 120, None, 'a|"b|c"|d|"e""f"|' + "x|" * 120, 'a|"open|b|c' + "|" * 104, "a|b\nc|d",
    "\\a|b\\|c|d", " a | b |\t", '"q"|""|"|"|' + "y|" * 104, "\n1|2", "#1|2|3", "\x00a|b|c",
    "\r\n1|2|3", "a\rb|c\n" + "|" * 107, "|", "\n", "'a|b'|c", '1|2|3|4|5|6|7|8|9|10|11|12|"13|14"|15' + "|" * 94, "ä|世|\U0001f600"]


@pytest.mark.parametrize("columns", [["loan_id"], ["upb_current", "reporting_period"], [NAMES[-1]], [NAMES[0]], []])
def test_wanted_fields_are_as_in_the_whole_line(spark, columns):
    lines = spark.createDataFrame(list(enumerate(LINES)), "k int, line string")
    whole = raw_files.parse_lines(lines).select("k", *[c for c in NAMES if c in columns])
    part = raw_files.parse_lines(lines, columns=columns)
    assert part.columns == whole.columns
    assert part.orderBy("k").collect() == whole.orderBy("k").collect()


def test_fields_behind_the_wanted_ones_are_not_made(spark):
    """All 108 fields became text for every line, whatever was read of them."""
    part = raw_files.parse_lines(spark.createDataFrame([("1|2",)], "line string"), columns=["loan_id"])
    plan = part._jdf.queryExecution().optimizedPlan().toString()
    assert "from_csv(StructField(reference_pool_id" in plan and "reporting_period" not in plan
    with pytest.raises(ValueError, match="nothing"):
        raw_files.parse_lines(spark.createDataFrame([("1|2",)], "line string"), columns=["loan_id", "nothing"])


def test_lines_without_quotes_are_cut(spark):
    """Every line with fields behind the wanted ones was reported as malformed, by an exception."""
    lines = spark.createDataFrame([("7|8" + "|x" * 106,)], "line string")
    plan = raw_files.parse_lines(lines, columns=["loan_id"])._jdf.queryExecution().analyzed().toString()
    assert "substring_index(line" in plan
    assert "substring_index" not in raw_files.parse_lines(lines)._jdf.queryExecution().analyzed().toString()


def test_months_are_read_as_by_their_format(spark):
    """A format was tried on every text, which took longer than the parsing of the line."""
    odd = ["", " 12018", "012018\n", "1٣" + "2018", "0120180", "13x018", "+12018", "-12018", "01201", None]
    texts = spark.range(1_000_000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("t")).union(
        spark.createDataFrame([(t,) for t in odd], "t string"))
    by_format = F.when(F.col("t").rlike("^[0-9]{6}$"), F.try_to_date("t", "MMyyyy"))
    assert texts.filter(~parse_month("t").eqNullSafe(by_format)).isEmpty()
    assert "gettimestamp" not in texts.select(parse_month("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert texts.filter(parse_month("t").isNotNull()).count() == 12 * 10_000
