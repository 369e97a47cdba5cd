"""Feature rows as Parquet, one partition per vintage."""

from __future__ import annotations

from contextlib import AbstractContextManager, nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lossloom.sources.warehouse import Warehouse, open_writers

TABLE = "feature_store"
# First vintage of a loan: one value per loan, and the vintage itself if the loan has only one.
HOME = "home_vintage"
# With 27 to 48 months per loan and 300 bytes per row, the sort of a part takes 0.4 to 0.8 GB.
LOANS_PER_PART = 50_000


def place_loans(loans: DataFrame) -> DataFrame:
    """Loans (one row each) in sorted ranges over :data:`HOME` and id, before they become months.

    Features of the months computed with ``placed=(HOME,)`` stay where they are and can be written
    by vintage without a shuffle, a sample or a second sort of the feature rows. There are at least
    as many parts as shuffle partitions, and more for many loans.
    """
    spark = loans.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                -(-loans.count() // LOANS_PER_PART))
    known = loans.filter(F.col("loan_id").isNotNull())
    homes = known.withColumn(HOME, F.min("vintage").over(W.partitionBy("loan_id")))
    return homes.repartitionByRange(parts, HOME, "loan_id").sortWithinPartitions(HOME, "loan_id")


def _writers(store: Warehouse, features: DataFrame) -> AbstractContextManager[None]:
    return open_writers(store.spark) if HOME in features.columns else nullcontext()


def write(store: Warehouse, features: DataFrame) -> None:
    """Replace the vintages in ``features``.

    Rows of placed loans are written as they come. Other rows arrive hashed by loan; ranges over
    vintage and loan give each vintage a few large files and split a vintage that holds much of the data.
    """
    if HOME not in features.columns:
        features = features.repartitionByRange("vintage", "loan_id").sortWithinPartitions(
            "vintage", "loan_id", "reporting_period")
    with _writers(store, features):
        store.replace_vintages(features.drop(HOME), TABLE)


def reset(store: Warehouse, features: DataFrame) -> None:
    """Start the store again with these rows only."""
    with _writers(store, features):
        features.drop(HOME).write.mode("overwrite").partitionBy("vintage").parquet(store.path(TABLE))


def scan(store: Warehouse) -> DataFrame:
    return store.read(TABLE)
