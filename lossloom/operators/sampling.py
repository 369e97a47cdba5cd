"""Repeatable sampling: whole loans by key hash, and exact-size samples by row hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lossloom.functions.hashing import hash32, in_fraction, one_in

BUCKETS = 1 << 16


def sample_loans(panel: DataFrame, fraction: float, seed: int | None = None,
                 key: str = "loan_id") -> DataFrame:
    """Keep about ``fraction`` of the loans with their whole history."""
    return panel if fraction >= 1.0 else panel.filter(in_fraction(key, fraction, seed))


def sample_one_in(panel: DataFrame, n: int, key: str = "loan_id") -> DataFrame:
    return panel.filter(one_in(key, n))


def row_key(*columns: str) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def take_by_hash(df: DataFrame, wanted: DataFrame, key: Column, seed: int,
                 klass: str = "target") -> DataFrame:
    """Exactly ``wanted.take_n`` rows per class, the ones with the smallest hashes of ``key``.

    The cut is found from row counts of 65,536 hash ranges, so nothing is sorted globally: whole
    ranges below the cut are kept, and only the one range that straddles it is ranked.
    ``wanted`` has one row per class: ``klass`` and ``take_n``.
    """
    hashed = df.withColumn("_h", hash32(key, seed)).withColumn("_tie", F.md5(key))
    hashed = hashed.withColumn("_range", F.floor(F.col("_h") / (1 << 16)).cast("int"))
    counts = hashed.groupBy(klass, "_range").agg(F.count(F.lit(1)).alias("_n"))
    upto = W.partitionBy(klass).orderBy("_range")  # at most BUCKETS rows per class
    ranges = (
        counts.withColumn("_before",
                          F.coalesce(F.sum("_n").over(upto.rowsBetween(W.unboundedPreceding, -1)),
                                     F.lit(0)))
        .join(wanted, klass)
        .filter(F.col("_before") < F.col("take_n"))
        .select(klass, "_range",
                (F.col("take_n") - F.col("_before")).alias("_room"),
                (F.col("_before") + F.col("_n") > F.col("take_n")).alias("_straddles"))
    )
    # One row per class and hash range: at most 65,536 x classes.
    marked = hashed.join(F.broadcast(ranges), [klass, "_range"])
    whole = marked.filter(~F.col("_straddles"))
    rank = W.partitionBy(klass, "_range").orderBy("_h", "_tie")
    partial = (marked.filter("_straddles")
               .withColumn("_rank", F.row_number().over(rank))
               .filter(F.col("_rank") <= F.col("_room")).drop("_rank"))
    return whole.unionByName(partial).drop("_h", "_tie", "_range", "_room", "_straddles")


def keep_rare_class(train: DataFrame, max_rows: int, key: Column, seed: int,
                    floor: int = 1000) -> DataFrame:
    """All positives, and negatives down to ``max(max_rows - positives, floor)``."""
    counts = train.groupBy("target").agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.agg(
        F.sum("rows").alias("all_rows"),
        F.coalesce(F.sum(F.when(F.col("target") == 1, F.col("rows"))), F.lit(0)).alias("pos"))
    room = F.greatest(F.lit(max_rows) - F.col("pos"), F.lit(floor))
    plan = totals.select(F.explode(F.array(
        F.struct(F.lit(1).alias("target"), F.col("pos").alias("take_n")),
        F.struct(F.lit(0).alias("target"),
                 F.when(F.col("all_rows") <= max_rows, F.col("all_rows")).otherwise(room)
                 .alias("take_n")))).alias("w")).select("w.*")
    return take_by_hash(train, plan, key, seed)


def keep_class_rates(frame: DataFrame, max_rows: int, key: Column, seed: int) -> DataFrame:
    """Both classes thinned by the same fraction ``max_rows / rows``."""
    counts = frame.groupBy("target").agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("all_rows")).scalar()
    share = F.least(F.lit(1.0), F.lit(float(max_rows)) / total)
    plan = counts.select("target", F.floor(F.col("rows") * share).alias("take_n"))
    return take_by_hash(frame, plan, key, seed)
