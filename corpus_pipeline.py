"""The corpus pipeline: rules, near-duplicates, benchmark passages, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``. ``run`` writes each stage to the shared checkpoint folder before the next.

In every stage null texts count as empty (the rules reject them), texts are read whole, rows with a
null id are documents of their own, rows repeated in id and text count as exact copies (one stays),
other columns pass through under any name, and an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossloom.llm import decontaminate, mixing, pii, quality_rules, simhash
from lossloom.llm.storage import stored


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality rules reject."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near copies: fingerprints of 3-word shingles that differ
    in at most 3 bits, as the near-duplicate operator links them."""
    return simhash.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; n_chars follows the text."""
    out = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw the sources at their target weights: adds epoch, block and n_tokens."""
    return mixing.draw(docs)


STAGES = [("quality_rules", rules), ("simhash_near_duplicates", near_duplicates),
          ("benchmark_decontamination", benchmark_passages), ("pii", personal_data),
          ("source_mixing", mixture)]

# Fingerprints, random permutations and learned patterns have no SQL form; tests hold the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
