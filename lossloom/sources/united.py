"""Parquet files whose columns or types differ, read as one table.

Files are grouped by the schema in their footers; each group is one scan, cast to the common type of
every column, and the groups are united by name. A common type holds every value of the types that it
stands for, so no value turns to null: numbers widen, a whole number and a fraction become a double,
a date and a time become a time, and anything with text becomes text. Files without a column have
nulls there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

#: Digits before the point of whole numbers.
WHOLE = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}
RANK = [BooleanType(), *WHOLE]


def supertype(a: DataType, b: DataType) -> DataType:
    """Smallest type that holds the values of both. Whole numbers beyond 2 ** 53 round where a column
    is a double elsewhere; decimals too wide for 38 digits become doubles."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StringType) or isinstance(b, StringType):
        return StringType()
    if a in RANK and b in RANK:
        return max(a, b, key=RANK.index)
    if {type(a), type(b)} == {DateType, TimestampType}:
        return TimestampType()
    fractions = (FloatType, DoubleType, DecimalType)
    numbers = [x for x in (a, b) if isinstance(x, fractions) or x in RANK]
    if len(numbers) == 2:
        if any(isinstance(x, FloatType | DoubleType) for x in numbers):
            small = (ByteType(), ShortType(), BooleanType())
            exact = all(isinstance(x, FloatType) or x in small for x in numbers)
            return FloatType() if exact else DoubleType()
        whole, digits = zip(*((x.precision - x.scale, x.scale) if isinstance(x, DecimalType)
                              else (WHOLE.get(x, 1), 0) for x in numbers), strict=True)
        width = max(whole) + max(digits)
        return DecimalType(width, max(digits)) if width <= 38 else DoubleType()
    raise TypeError(f"no common type of {a.simpleString()} and {b.simpleString()}")


def united_schema(schemas: Sequence[StructType]) -> StructType:
    """All columns in order of first appearance, each with the common type of its own."""
    found: dict[str, DataType] = {}
    for schema in schemas:
        for f in schema:
            try:
                found[f.name] = supertype(found.get(f.name, NullType()), f.dataType)
            except TypeError as error:
                raise TypeError(f"column {f.name}: {error}") from None
    return StructType([StructField(n, t) for n, t in found.items()])


def cast_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order; missing ones are null. Numbers that become text keep
    their plain form."""
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema])


def read_united(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One table from Parquet files or folders (one footer each is read on the driver; a folder must
    hold files of one schema). As many scans as there are different schemas."""
    if not paths:
        raise ValueError("no files to read")
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for path in paths:
        schema = spark.read.parquet(path).schema
        groups.setdefault(schema.json(), (schema, []))[1].append(path)
    wanted = united_schema([schema for schema, _ in groups.values()])
    return reduce(DataFrame.unionByName, [
        cast_to(spark.read.schema(schema).parquet(*own), wanted) for schema, own in groups.values()])
