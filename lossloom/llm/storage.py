"""Lineage cuts in shared storage and joins whose small side is measured first."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.operators.durable import use_checkpoint_dir

SMALL_ROWS, SMALL_BYTES = 100_000, 8_000_000
SALTS = 32


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Later branches read the same rows whatever executors are lost; Parquet keeps column pruning.
    """
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, *texts: str) -> bool:
    """True if ``df`` holds at most SMALL_ROWS rows and its ``texts`` at most SMALL_BYTES bytes."""
    bytes_ = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(bytes_.cast("long")).alias("b")).first()
    return row["n"] <= SMALL_ROWS and (row["b"] or 0) <= SMALL_BYTES


def join_on_hot_key(left: DataFrame, right: DataFrame, key: str, spread: str,
                    how: str = "left") -> DataFrame:
    """Join ``right`` (one row per non-null text ``key``) to ``left``, whose keys may be hot.

    A measured small right side is broadcast. Otherwise each right row is repeated once per salt,
    and rows of a hot key go to SALTS tasks by the hash of ``spread``.
    """
    if is_small(right, key):
        return left.join(F.broadcast(right), key, how)
    salted = left.withColumn("__ll_salt", F.pmod(F.hash(spread), F.lit(SALTS)))
    copies = right.withColumn("__ll_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # Spark takes the copies for as large as ``right``, so it would broadcast up to SALTS times its limit.
    return salted.join(copies.hint("merge"), [key, "__ll_salt"], how).drop("__ll_salt")
