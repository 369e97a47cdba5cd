"""Lineage cuts that survive lost executors, and broadcasts behind a size check."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_ROWS, SMALL_BYTES = 100_000, 64_000_000


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; only a local session may fall back to /tmp."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lossloom-checkpoint-")
    context.setCheckpointDir(folder)


def durable(df: DataFrame) -> DataFrame:
    """Store ``df`` reliably, so that every later branch reads exactly the same rows."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def durable_columns(df: DataFrame, by: str | None = None) -> DataFrame:
    """:func:`durable` for many rows that are read a few columns at a time: packed columns, in folders by
    column ``by``, so that a filter on it reads no others."""
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/columns-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS,
               max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Materialise an aggregate once and hint a broadcast only if it really is small.

    Beyond ``max_rows``, or ``max_bytes`` of its rows as text, the frame comes back without a hint and
    the join shuffles.
    """
    kept = durable(df)
    size = kept.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length(F.to_json(
        F.struct("*")))), F.lit(0)).alias("bytes")).first()
    return F.broadcast(kept) if size["rows"] <= max_rows and size["bytes"] <= max_bytes else kept
