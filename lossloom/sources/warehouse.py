"""Tables kept as Parquet folders below one root, partitioned by vintage where they grow."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossloom import schema

VINTAGE_TABLES = ("loan_master", "loan_monthly")
# Fixed value: characters of an audit message.
MESSAGE_WIDTH = 500


@contextmanager
def open_writers(spark: SparkSession, files: int = 8) -> Iterator[None]:
    """Partitioned writes of rows that nearly arrive by part: a task keeps up to ``files`` parts open
    instead of sorting all its rows; only the rows of further parts are sorted."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, files)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def read(self, table: str, columns: list[str] | None = None) -> DataFrame:
        df = self.spark.read.parquet(self.path(table))
        return df.select(*columns) if columns else df

    def append(self, df: DataFrame, table: str) -> None:
        df.write.mode("append").parquet(self.path(table))

    def replace(self, df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").parquet(self.path(table))

    def replace_vintages(self, df: DataFrame, table: str) -> None:
        """Swap in exactly the vintages that occur in ``df``; a rerun gives the same table."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("vintage").parquet(self.path(table)))

    def save_bucketed(self, df: DataFrame, name: str, buckets: int,
                      key: str = "loan_id") -> None:
        """Catalog table bucketed and sorted by loan: later joins and windows skip the shuffle."""
        (df.write.mode("overwrite").format("parquet").bucketBy(buckets, key)
         .sortBy(key, "reporting_period").option("path", self.path(name)).saveAsTable(name))


def ingested_vintages(log: DataFrame) -> DataFrame:
    return log.filter(F.col("status") == "SUCCESS").select("vintage").distinct()


def not_yet_ingested(files: DataFrame, log: DataFrame | None, force: bool = False) -> DataFrame:
    if log is None or force:
        return files
    return files.join(ingested_vintages(log), "vintage", "left_anti")


def log_rows(counts: DataFrame, status: str, sample_fraction: float,
             message: str = "") -> DataFrame:
    """Audit rows from ``vintage, source_file, rows_master, rows_monthly``.

    The message is cut to the width of its field.
    """
    return counts.select(
        "vintage", "source_file", F.col("rows_master").cast("bigint").alias("rows_master"),
        F.col("rows_monthly").cast("bigint").alias("rows_monthly"),
        F.lit(float(sample_fraction)).alias("sample_fraction"), F.lit(status).alias("status"),
        F.lit(message[:MESSAGE_WIDTH]).alias("message"), F.current_timestamp().alias("finished_at"))


def data_dictionary(spark: SparkSession) -> DataFrame:
    """One row per table column, from the metadata of the table schemas."""
    kinds = {"double": "numeric", "date": "date", "string": "text"}
    rows = [
        (table, f.name, f.metadata["official_name"], kinds[f.dataType.simpleString()],
         f.metadata["is_static"])
        for table, struct in (("loan_master", schema.LOAN_MASTER),
                              ("loan_monthly", schema.LOAN_MONTHLY))
        for f in struct
        if "official_name" in f.metadata and f.name not in ("loan_id", "reporting_period")]
    return spark.createDataFrame(
        rows, "table_name string, db_column string, official_name string, data_type string, "
              "is_static boolean")


def missing_entries(dictionary: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Dictionary rows whose key is not there yet."""
    if existing is None:
        return dictionary
    return dictionary.join(existing.select("table_name", "db_column"),
                           ["table_name", "db_column"], "left_anti")
