"""Registered queries of the operators in this folder: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossloom.llm import (
    decontaminate,
    exact_copies,
    language,
    language_model,
    line_quality,
    mixing,
    pii,
    pivot_clusters,
    preferences,
    quality_rules,
    secrets,
    simhash,
    spelling,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


@query("op5_quality_rules", quality_rules.oracle())
def op5(spark, sf):
    return quality_rules.judge(table(spark, sf, "documents")).withColumn(
        "host_rate", F.round("host_rate", 9))


@query("op6_simhash_near_dedup")
def op6(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query("op7_benchmark_decontamination")
def op7(spark, sf):
    return decontaminate.find_passages(table(spark, sf, "documents"),
                                       table(spark, sf, "benchmark"))


@query("op2_pii_bootstrap")
def op2(spark, sf):
    return pii.digest(pii.find_pii(table(spark, sf, "documents")))


@query("op1_source_mixing", mixing.oracle())
def op1(spark, sf):
    return mixing.mixed(table(spark, sf, "documents"))


@query("op8_line_crf_quality")
def op8(spark, sf):
    return line_quality.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op9_language_mixture")
def op9(spark, sf):
    return language.predict_languages(table(spark, sf, "documents"))


@query("op3_bloom_language_model")
def op3(spark, sf):
    return language_model.score_documents(table(spark, sf, "documents"))


@query("op4_secret_forest")
def op4(spark, sf):
    return secrets.scan(table(spark, sf, "documents"))


@query("op10_preference_formatting", preferences.oracle())
def op10(spark, sf):
    convs = preferences.conversations(table(spark, sf, "conversations"))
    return preferences.digest(preferences.format_pairs(preferences.rejected_replies(convs)))


@query("op11_pivot_clusters", pivot_clusters.oracle())
def op11(spark, sf):
    return pivot_clusters.cluster_vectors(table(spark, sf, "embeddings"))


@query("op12_exact_copies", exact_copies.oracle())
def op12(spark, sf):
    return exact_copies.judge(table(spark, sf, "documents"))


@query("op13_spelling_variants", spelling.oracle())
def op13(spark, sf):
    return spelling.spelling_variants(table(spark, sf, "documents"))
