"""Late and corrected quarters as they arrive: a file stream that keeps the loan tables current.

The stream only tells which quarters have new files. Each batch then loads these quarters whole,
from all their files, with the same width check and audit rows as the batch ingest; so the tables
do not depend on how files fell into batches, and a batch that runs twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lossloom.functions.dates import vintage_in_name
from lossloom.plans.ingest import load_and_log
from lossloom.sources import raw_files as raw
from lossloom.sources.versions import VersionedWarehouse


def quarter_stream(spark: SparkSession, folder: str,
                   max_files: int | None = None) -> DataFrame:
    """(file, vintage) of the lines of new files; the file source remembers what it has seen."""
    stream = spark.readStream.format("text")
    if max_files is not None:
        stream = stream.option("maxFilesPerTrigger", max_files)
    return (stream.load(folder).select(F.col("_metadata.file_name").alias("file"))
            .withColumn("vintage", vintage_in_name("file"))
            .filter(F.col("vintage").isNotNull()))


def start_ingest(spark: SparkSession, folder: str, root: str, checkpoint: str,
                 max_files: int | None = None) -> StreamingQuery:
    """Process everything that is there and stop; run again (or on a schedule) for later files.

    ``checkpoint`` must be on storage that every executor reaches.
    """
    store = VersionedWarehouse(spark, root)

    def reload(batch: DataFrame, _batch_id: int) -> None:
        found = [r["vintage"] for r in batch.select("vintage").distinct().collect()]  # quarters
        if found:
            files = raw.list_files(spark, folder).filter(F.col("vintage").isin(*found))
            load_and_log(spark, raw.inspect(spark, files), store)

    return (quarter_stream(spark, folder, max_files).writeStream.foreachBatch(reload)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
