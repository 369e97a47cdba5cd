"""Month arithmetic on integer month numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_number(c: str | Column) -> Column:
    """Months since year 0: differences count calendar months."""
    return F.year(c) * 12 + F.month(c)


def month_start(c: str | Column) -> Column:
    return F.trunc(c, "month")


def quarter_start(c: str | Column) -> Column:
    return F.trunc(c, "quarter")


def parse_month(c: str | Column) -> Column:
    """``MMYYYY`` text to the first day of the month; anything else to null."""
    text = F.col(c) if isinstance(c, str) else c
    # Every such text is a date, so no format is tried, which takes longer than the rest of a row's parsing.
    return F.when(text.rlike(r"^(0[1-9]|1[0-2])[0-9]{4}\z"), F.make_date(
        F.substring(text, 3, 4).cast("int"), F.substring(text, 1, 2).cast("int"), F.lit(1)))


def vintage_of(c: str | Column) -> Column:
    """Origination quarter label such as ``2018Q1``."""
    return F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string"))


# Fixed value: how a file name carries its quarter.
VINTAGE_PATTERN = r"(20\d{2})[\-_ ]?[Qq]([1-4])"


def vintage_in_name(c: str | Column) -> Column:
    """Quarter label found anywhere in a file name, null when there is none."""
    year = F.regexp_extract(c, VINTAGE_PATTERN, 1)
    return F.when(year != "", F.concat(year, F.lit("Q"), F.regexp_extract(c, VINTAGE_PATTERN, 2)))


def quarter_index(vintage: str | Column) -> Column:
    """Consecutive integer of a ``YYYYQn`` label of this century, null for other text."""
    text = F.col(vintage) if isinstance(vintage, str) else vintage
    year, quarter = F.substring(text, 1, 4), F.substring(text, 6, 1)
    return F.when(text.rlike("^20[0-9]{2}Q[1-4]"),
                  year.try_cast("int") * 4 + quarter.try_cast("int") - 1)


def quarter_label(index: str | Column) -> Column:
    i = F.col(index) if isinstance(index, str) else index
    return F.concat(F.floor(i / 4).cast("string"), F.lit("Q"), (i % 4 + 1).cast("string"))
