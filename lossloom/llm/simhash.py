"""Near-duplicates by 64-bit SimHash fingerprints of 3-word shingles.

Links join fingerprints that differ in at most ``RADIUS`` bits; classes are the connected
components of the links. Work runs on distinct fingerprints, so copies cost one row.

A table of Hamming distances to reference fingerprints (pivots) stands beside each distinct
fingerprint. By the triangle inequality two linked fingerprints differ by at most RADIUS in every
coordinate, so a pair with a larger difference is discarded without a look at its bits; survivors
are verified bit by bit. Which pairs meet at all is decided by equality on bit blocks: of b blocks
at most RADIUS can differ, so linked fingerprints agree on some b - RADIUS of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lossloom.llm.components import connected_components
from lossloom.llm.storage import stored

RADIUS = 3
SHINGLE = 3
SEED = 42
PIVOTS = 16
#: Buckets with more distinct fingerprints are linked by shared variants, not by pairs.
HOT_BUCKET = 512
CHUNK = 1 << 16


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the whole text as a signed 64-bit number; no words (or null): zero."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        part = words[start:start + CHUNK + shingle - 1]
        grams = (map(b" ".join, zip(*(part[k:] for k in range(shingle)), strict=False))
                 if len(words) >= shingle else [b" ".join(words)])
        h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


@F.pandas_udf(LongType())
def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([text_fingerprint(t) for t in batch], dtype="int64")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: hashes of their number."""
    return [signed(xxhash.xxh64_intdigest(f"reference {i}", SEED)) for i in range(n)]


def pivot_table(fp: Column, n: int = PIVOTS) -> Column:
    """Distances to the references, a byte each, eight to a 64-bit number."""
    refs = pivots(n)
    packed = []
    for start in range(0, n, 8):
        parts = [F.shiftleft(distance(fp, F.lit(r)).cast("long"), 8 * k)
                 for k, r in enumerate(refs[start:start + 8])]
        word = parts[0]
        for p in parts[1:]:
            word = word.bitwiseOR(p)
        packed.append(word)
    return F.array(*packed)


def within_coordinates(a: Column, b: Column, radius: int = RADIUS, n: int = PIVOTS) -> Column:
    """No coordinate of two pivot tables differs by more than ``radius``."""
    gaps = []
    for i in range(n):
        x, y = (F.shiftrightunsigned(F.get(t, F.lit(i // 8)), 8 * (i % 8)).bitwiseAND(F.lit(255))
                for t in (a, b))
        gaps.append(F.abs(x - y))
    return F.greatest(*gaps) <= radius


def blocks_for(n: int, radius: int = RADIUS) -> int:
    """Fewest blocks whose keys are wide enough that chance shares stay below one per key."""
    for b in range(radius + 2, 17):
        if 64 * (b - radius) / b >= np.log2(max(n, 2)):
            return b
    return 16


def block_keys(blocks: int, radius: int = RADIUS) -> list[tuple[int, list[int]]]:
    """(mask of the compared bits, the free bits) of every choice of ``radius`` free blocks."""
    edge = [round(64 * i / blocks) for i in range(blocks + 1)]
    out = []
    for free in combinations(range(blocks), radius):
        bits = [k for j in free for k in range(edge[j], edge[j + 1])]
        out.append((signed(((1 << 64) - 1) ^ sum(1 << k for k in bits)), bits))
    assert len(out) == comb(blocks, radius)
    return out


def links(prints: DataFrame, radius: int = RADIUS, hot: int = HOT_BUCKET,
          n_pivots: int = PIVOTS) -> DataFrame:
    """Edges (a, b) over distinct fingerprints ``fp`` that connect exactly what is linked.

    In ordinary buckets every linked pair is an edge. In a bucket with over ``hot`` fingerprints
    pairs would grow with its square, so there members that share a variant (a value at most one
    bit from one of them and two from the other) are tied to the smallest member one bit away:
    each such edge is a link, and any linked pair meets in some variant. At most 1 + f + f(f-1)/2
    fingerprints can share a variant of f free bits, so no group is unbounded.
    """
    keys = block_keys(blocks_for(prints.count(), radius), radius)
    table = prints.select("fp", pivot_table(F.col("fp"), n_pivots).alias("table"))
    rows = table.select("fp", "table", F.posexplode(F.array(
        *(F.col("fp").bitwiseAND(F.lit(m)) for m, _ in keys))).alias("k", "v"))
    sizes = rows.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = stored(rows.join(sizes, ["k", "v"]))
    few = met.filter(F.col("n") <= hot).drop("n")
    a, b = few.alias("a"), few.alias("b")
    pairs = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.v") == F.col("b.v"))
                   & (F.col("a.fp") < F.col("b.fp"))
                   & within_coordinates(F.col("a.table"), F.col("b.table"), radius, n_pivots))
    found = pairs.filter(distance(F.col("a.fp"), F.col("b.fp")) <= radius).select(
        F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    many = met.filter(F.col("n") > hot)
    if many.isEmpty():
        return found.distinct()
    return found.unionByName(variant_links(many, keys, radius)).distinct()


def variant_links(members: DataFrame, keys: list[tuple[int, list[int]]],
                  radius: int = RADIUS) -> DataFrame:
    """Star edges of members (k, fp) that share a variant; for a radius of 3."""
    if radius != 3:
        raise ValueError("variants are laid out for a radius of 3")
    flips = [[1 << i for i in bits] for _, bits in keys]
    near = F.array(*(F.array(F.lit(0), *(F.lit(signed(x)) for x in f)) for f in flips))
    far = F.array(*(F.array(*(F.lit(signed(x | y)) for x, y in combinations(f, 2)))
                    for f in flips))

    def spread(table: Column, is_near: bool) -> DataFrame:
        return members.select("k", "fp", F.explode(table[F.col("k")]).alias("flip")).select(
            "k", F.col("fp").bitwiseXOR(F.col("flip")).alias("v"), "fp",
            F.lit(is_near).alias("near"))

    shared = spread(near, True).unionByName(spread(far, False)).groupBy("k", "v").agg(
        F.min(F.when(F.col("near"), F.col("fp"))).alias("b"), F.collect_list("fp").alias("all"))
    return shared.filter(F.col("b").isNotNull() & (F.size("all") > 1)).select(
        F.explode("all").alias("a"), "b").filter("a <> b")


def classes(prints: DataFrame, **options) -> DataFrame:
    """(fp, root) of every linked fingerprint of ``prints``; the others are their own class."""
    return stored(connected_components(links(prints, **options)).select(
        F.col("node").alias("fp"), "root"))


def digest(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return stored(docs.select(F.col(doc_id).alias("id"), fingerprint(text).alias("fp")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id: one row per row of ``docs``.

    Null and empty texts have fingerprint zero and are linked like any other. component_id is the
    smallest id of the class, null ids left aside (null if the class has no other). Repeated rows
    each get a row; an empty table gives none. Fingerprints with over a thousandth of all rows
    are fewer than a thousand: their rows meet the classes in a broadcast join, so that no task
    receives the copies of one text.
    """
    rows = digest(docs, doc_id, text)
    prints = stored(rows.groupBy("fp").agg(F.min("id").alias("least"),
                                           F.count(F.lit(1)).alias("n")))
    tied = prints.join(classes(prints.select("fp")), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = tied.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(tied.join(least, "root").select("fp", "n", "component_id"))
    cut = rows.count() / 1000
    hot = F.broadcast(named.filter(F.col("n") > cut).drop("n"))
    cold = named.filter(F.col("n") <= cut).drop("n")
    joined = rows.join(hot, "fp").unionByName(
        rows.join(hot.select("fp"), "fp", "left_anti").join(cold, "fp"))
    return joined.select(F.col("id").alias(doc_id),
                         F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` per class: the row of the smallest id (null ids last).

    Null and empty texts are one class. Rows are told apart by id and fingerprint; of rows alike in
    both one stays. An empty table gives no rows, other columns pass through. The fingerprint
    is computed again beside the text, and the rows kept are found by a join on id and
    fingerprint, which has no hot keys.
    """
    rows = digest(docs, doc_id, text)
    prints = stored(rows.groupBy("fp").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id")).alias("first")))
    tied = prints.join(classes(prints.select("fp")), "fp", "left")
    chosen = tied.groupBy(F.coalesce("root", "fp").alias("root")).agg(
        F.min(F.struct("first.no_id", "first.id", "fp")).alias("c")).select(
        F.col("c.id").alias("__ll_id"), F.col("c.fp").alias("__ll_fp"))
    chosen = stored(chosen)
    both = F.col("__ll_id").eqNullSafe(F.col("id")) & (F.col("__ll_fp") == F.col("fp"))
    again = chosen.join(rows, both).groupBy("__ll_id", "__ll_fp").agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    again = stored(again)
    marked = docs.withColumn("__ll_print", fingerprint(text))

    def same(right: DataFrame) -> Column:
        return marked[doc_id].eqNullSafe(right["__ll_id"]) & (
            marked["__ll_print"] == right["__ll_fp"])

    if again.isEmpty():
        return marked.join(chosen, same(chosen), "left_semi").select(*docs.columns)
    once = chosen.join(again, chosen["__ll_id"].eqNullSafe(again["__ll_id"])
                       & (chosen["__ll_fp"] == again["__ll_fp"]), "left_anti")
    single = marked.join(once, same(once), "left_semi")
    repeated = marked.join(again, same(again), "left_semi").dropDuplicates([doc_id, "__ll_print"])
    return single.unionByName(repeated).select(*docs.columns)
