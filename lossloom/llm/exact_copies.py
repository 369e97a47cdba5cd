"""Exact copies by a heavy-hitter split of text digests.

A Misra-Gries summary of the digests (Spark's frequent-items sketch, whose counters are lowered
together when the table is full) names every digest that may hold more than ``SHARE`` of all rows.
The named digests are counted exactly; those that really are frequent, at most 1 / SHARE of them,
travel with their winner to all workers, where rows of their groups are judged without a
shuffle. No other digest has more than that share of the rows, so they take an ordinary one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.llm.storage import stored
from lossloom.llm.text import whole

#: Digests of more than this part of all rows are frequent: fewer than 1000 of them.
SHARE = 1 / 1000
#: Counters of the summary. Its error is at most 3.5 / COUNTERS of the rows, so whatever holds more
#: than twice that, 1 / 2340 of the rows, is named; fewer than NAMED digests can be.
COUNTERS, NAMED = 16_384, 2_400
#: Summaries merge in so many groups before the last one.
MERGES = 64


def sha(text: str) -> Column:
    """SHA-256 of the text in UTF-8, 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(whole(text).cast("binary"), 256))


def digest(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, id, sha) of every row, written once: numbers of rows stay what they are."""
    return stored(docs.select(F.monotonically_increasing_id().alias("row"),
                              F.col(doc_id).alias("id"), sha(text).alias("sha")))


def named(rows: DataFrame, counters: int = COUNTERS, top: int = NAMED) -> DataFrame:
    """(key): 64 bits of the digests that the Misra-Gries summary of all rows still counts."""
    parts = rows.select(key().alias("key")).groupBy(
        F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(key, {counters})").alias("s"))
    table = parts.groupBy(F.lit("all")).agg(  # no rows give no summary
        F.expr(f"approx_top_k_combine(s, {counters})").alias("s"))
    return table.select(F.explode(F.expr(f"approx_top_k_estimate(s, {min(top, counters)})")).alias("e")).select(
        "e.item").toDF("key")


def key() -> Column:
    """64 bits of the digest: the items of the summary, which only names candidates."""
    return F.xxhash64("sha")


def winner() -> Column:
    """Largest id of a group (nulls are smallest); of repeated rows the last."""
    return F.max(F.struct("id", "row")).alias("win")


def frequent(rows: DataFrame, share: float = SHARE, counters: int = COUNTERS,
             top: int = NAMED) -> DataFrame:
    """(sha, win, n) of the digests with over ``share`` of all rows: fewer than 1 / share rows."""
    total = rows.count()
    few = F.broadcast(named(rows, counters, top))
    met = rows.withColumn("key", key()).join(few, "key", "left_semi")
    return stored(met.groupBy("sha").agg(winner(), F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > F.lit(total * share)))


def grouped(rows: DataFrame, **options) -> DataFrame:
    """``rows`` (row, id, sha) with ``win`` (id and row of the one that stays) and ``n``.

    Rows of frequent digests meet their winners in a broadcast join of fewer than 1 / share rows.
    """
    hot = F.broadcast(frequent(rows, **options))
    rest = rows.join(hot.select("sha"), "sha", "left_anti")
    per = rest.groupBy("sha").agg(winner(), F.count(F.lit(1)).alias("n"))
    columns = ["row", "id", "sha", "win", "n"]
    return rows.join(hot, "sha").select(*columns).unionByName(
        rest.join(per, "sha").select(*columns))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``.

    Texts are equal if their bytes are; null counts as empty. Of equal texts the row with the
    largest id stays: a null id is the smallest, and of rows alike in id and text exactly one
    stays (keep_id is null if a group has no other id). An empty table gives no rows; texts of any
    length are digested whole, in one pass, and do not travel. Other columns do not matter.
    """
    out = grouped(digest(docs, doc_id, text), **options)
    return out.select(F.col("id").alias(doc_id), F.col("win.id").alias("keep_id"),
                      F.col("n").alias("group_size"),
                      (F.col("row") == F.col("win.row")).alias("kept"),
                      F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                **options) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, all columns, whatever their names.

    Copies with a frequent digest are removed before any shuffle. What is left meets the winners
    by id and digest; rows alike in both are reduced to one.
    """
    rows = digest(docs, doc_id, text)
    hot = frequent(rows, **options)
    rest = rows.join(F.broadcast(hot.select("sha")), "sha", "left_anti")
    wins = rest.groupBy("sha").agg(winner()).select("sha", "win").unionByName(
        hot.select("sha", "win"))
    wins = stored(wins.select(F.col("sha").alias("__ll_sha"), F.col("win.id").alias("__ll_id")))
    marked = docs.withColumn("__ll_own", sha(text))
    first = F.broadcast(hot.select(F.col("sha").alias("__ll_hot"), F.col("win.id").alias("__ll_top")))
    left = marked.join(first, F.col("__ll_own") == F.col("__ll_hot"), "left").filter(
        F.col("__ll_hot").isNull() | F.col(doc_id).eqNullSafe(F.col("__ll_top")))
    same = (F.col("__ll_own") == F.col("__ll_sha")) & F.col(doc_id).eqNullSafe(F.col("__ll_id"))
    kept = left.join(wins, same, "left_semi")
    twice = stored(rows.join(wins, (F.col("sha") == F.col("__ll_sha"))
                             & F.col("id").eqNullSafe(F.col("__ll_id"))).groupBy("id", "sha").agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        F.col("id").alias("__ll_rid"), F.col("sha").alias("__ll_rsha")))
    if twice.isEmpty():
        return kept.select(*docs.columns)
    repeated = (F.col("__ll_own") == F.col("__ll_rsha")) & F.col(doc_id).eqNullSafe(F.col("__ll_rid"))
    return kept.join(twice, repeated, "left_anti").unionByName(
        kept.join(twice, repeated, "left_semi").dropDuplicates([doc_id, "__ll_own"])).select(
        *docs.columns)


def oracle(documents: str = "documents") -> str:
    return f"""
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 as kept,
       sha256(coalesce(text, '')) as text_sha256
from {documents} window same as (partition by coalesce(text, ''))"""
