"""Passages of benchmark items inside documents.

For every item, windows of the item's length slide over each whole document. A window's SimHash
over its weighted 5-word shingles is looked up in Hamming block tables of the items of that
length. Fingerprints are cut into BLOCKS blocks with a radius of their own: of two that differ in at
most R bits, some block differs in at most R // BLOCKS. A table per block holds the items by the
value of the block; a window asks for all values within the block's radius. Candidates within R are verified by the exact weighted similarity of their shingles (sum of
minima over sum of maxima of the counts, 0.8 or more).

Only windows that hold enough shingles of some item of their length are fingerprinted: fewer than
0.8 / 1.8 of both sides' shingles cannot reach the similarity, so this drops nothing.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.llm.storage import stored

SHINGLE = 5
SIMILARITY = 0.8
#: At 0.8 a 64-bit fingerprint differs in about 10 bits (deviation 3), unrelated ones in 32 (deviation
#: 4): a radius of 19 keeps over 99 of 100 windows. Four blocks of 16 bits have a radius of 4 each, which
#: 14 of 100 unrelated items meet in some block.
RADIUS, BLOCKS = 19, 4
#: Items sent to the workers at a time, in bytes of text; more items take more passes.
PASS_BYTES = 32_000_000
HITS = "array<struct<item:string,first_word:int,n_words:int,similarity:double>>"

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_CHUNK = 4096


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, without ASCII punctuation."""
    return (text or "").encode().translate(_LOWER, _PUNCTUATION).split()


def shingle_hashes(ids: np.ndarray) -> np.ndarray:
    """One 64-bit number per run of SHINGLE word numbers."""
    n = len(ids) - SHINGLE + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(SHINGLE):
        out += ids[k:n + k] * _MIX[k]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def window_prints(hashes: np.ndarray, width: int) -> np.ndarray:
    """SimHash of every window of ``width`` neighbouring shingles, repeats counted."""
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(ones, axis=0, dtype=np.int32, out=sums[1:])
    bits = 2 * (sums[width:] - sums[:-width]) > width
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]


def similarity(a: Counter, b: Counter) -> float:
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return both / (a.total() + b.total() - both)


BITS = 64 // BLOCKS
ONES = np.array([x.bit_count() for x in range(1 << BITS)], np.uint8)


def block(prints: np.ndarray, k: int) -> np.ndarray:
    """Value of block ``k`` of fingerprints."""
    return (prints >> np.uint64(BITS * k) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints, element by element."""
    return sum(ONES[block(a ^ b, k)].astype(np.int64) for k in range(BLOCKS))


class BlockTables:
    """Multi-index over the fingerprints of items: sorted block values, one table per block."""

    def __init__(self, prints: list[int], radius: int):
        self.prints, self.radius = np.array(prints, np.uint64), radius
        self.flips = np.flatnonzero(ONES <= radius // BLOCKS)
        self.tables = []
        for k in range(BLOCKS):
            values = block(self.prints, k)
            order = np.argsort(values, kind="stable")
            self.tables.append((values[order], order))

    def met(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the block radius in some block.

        The values in reach are enumerated, unless the table has fewer values than that: then each
        of its values is tried.
        """
        pairs = []
        for k, (values, order) in enumerate(self.tables):
            own = block(prints, k)
            if len(values) <= len(self.flips):
                w, at = np.nonzero(ONES[own[:, None] ^ values[None, :]] <= self.radius // BLOCKS)
                pairs.append((w, order[at]))
                continue
            for w, x in enumerate(own.tolist()):
                near = x ^ self.flips
                low, high = (np.searchsorted(values, near, side=s) for s in ("left", "right"))
                runs = [order[a:b] for a, b in zip(low, high, strict=True) if a < b]
                if runs:
                    items = np.concatenate(runs)
                    pairs.append((np.full(len(items), w), items))
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        n = len(self.prints)
        both = np.unique(np.concatenate([w * n + i for w, i in pairs]))
        return both // n, both % n

    def near(self, prints: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, item) pairs within the radius."""
        w, i = self.met(prints)
        close = distances(prints[w], self.prints[i]) <= self.radius
        return zip(w[close].tolist(), i[close].tolist(), strict=True)


@dataclass
class _Length:
    """Items of one number of words and the block tables over their fingerprints."""
    items: list[int] = field(default_factory=list)
    prints: list[int] = field(default_factory=list)
    shingles: list[Counter] = field(default_factory=list)
    tables: BlockTables | None = None


class Index:
    """Items by length; built once per worker from a broadcast of bounded size."""

    def __init__(self, items: list[tuple[str, str]], radius: int = RADIUS,
                 at_least: float = SIMILARITY):
        self.names = [name for name, _ in items]
        self.radius, self.at_least = radius, at_least
        self.vocabulary: dict[bytes, int] = {}
        self.lengths: dict[int, _Length] = defaultdict(_Length)
        of: dict[int, set[int]] = defaultdict(set)
        for i, (_, text) in enumerate(items):
            words = tokens(text)
            if len(words) < SHINGLE:
                continue
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            hashes = shingle_hashes(np.array(ids, np.uint64))
            group = self.lengths[len(words)]
            group.items.append(i)
            group.prints.append(int(window_prints(hashes, len(hashes))[0]))
            group.shingles.append(Counter(hashes.tolist()))
            for h in hashes.tolist():
                of[h].add(len(words))
        for group in self.lengths.values():
            group.tables = BlockTables(group.prints, radius)
        self.known = np.array(sorted(of), np.uint64)
        self.lengths_of = [sorted(of[int(h)]) for h in self.known]

    def hits(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(item, first word, words, similarity): the best window of every item found."""
        words = tokens(text)
        if len(words) < SHINGLE or not len(self.known):
            return []
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        run = np.concatenate(([0], np.cumsum(ids != 0)))
        if not (run[SHINGLE:] - run[:-SHINGLE] == SHINGLE).any():
            return []
        hashes = shingle_hashes(ids)
        at = np.searchsorted(self.known, hashes).clip(max=len(self.known) - 1)
        places = np.flatnonzero((self.known[at] == hashes)
                                & (run[SHINGLE:] - run[:-SHINGLE] == SHINGLE))
        by_length: dict[int, list[int]] = defaultdict(list)
        for p in places.tolist():
            for n in self.lengths_of[at[p]]:
                by_length[n].append(p)
        best: dict[int, tuple[float, int, int]] = {}
        for n, found in by_length.items():
            self._scan(hashes, n, np.array(found), best)
        return [(self.names[i], s, n, sim) for i, (sim, s, n) in sorted(best.items())]

    def _scan(self, hashes: np.ndarray, n: int, found: np.ndarray, best: dict) -> None:
        whole = n - SHINGLE + 1
        width = min(whole, len(hashes))
        enough = max(1, ceil(self.at_least / (1 + self.at_least) * (whole + width) - 1e-9))
        if len(found) < enough:
            return
        last = found[enough - 1:]
        first = found[:len(last)]
        low = np.maximum(last - width + 1, 0)
        high = np.minimum(first, len(hashes) - width)
        marks = np.zeros(len(hashes) + 2, np.int32)
        fits = low <= high
        np.add.at(marks, low[fits], 1)
        np.add.at(marks, high[fits] + 1, -1)
        starts = np.flatnonzero(np.cumsum(marks) > 0)
        group = self.lengths[n]
        for stretch in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            for k in range(0, len(stretch), _CHUNK):
                part = stretch[k:k + _CHUNK]
                prints = window_prints(hashes[part[0]:part[-1] + width], width)
                for w, item in group.tables.near(prints):
                    i, s = group.items[item], int(part[w])
                    if i in best and best[i][0] == 1.0:
                        continue
                    sim = similarity(Counter(hashes[s:s + width].tolist()), group.shingles[item])
                    if sim >= self.at_least and (i not in best or sim > best[i][0]):
                        best[i] = (sim, s, width + SHINGLE - 1)


def _finder(spark, items: list[tuple[str, str]], radius: int, at_least: float):
    shared = spark.sparkContext.broadcast(items)

    @F.pandas_udf(HITS)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(shared.value, radius, at_least)
        for batch in texts:
            yield pd.Series([index.hits(t) for t in batch])

    return find


def _passes(bench: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str, str]]]:
    """The benchmark in parts of about PASS_BYTES; each part fits the driver and the workers."""
    size = bench.agg(F.sum(F.octet_length(text).cast("long") + 64)).first()[0] or 0
    parts = ceil(size / PASS_BYTES)
    named = bench.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t"))
    for k in range(parts):
        part = named.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == k)
        yield sorted(((r["i"], r["t"]) for r in part.collect()), key=str)


def find_passages(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", radius: int = RADIUS,
                  at_least: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, first_word, n_words, similarity: the best window per row and item.

    Nulls and empty texts hold nothing; items of fewer than five words have no shingle and are
    never found; a document shorter than the item is one window. Repeated rows are reported each.
    Documents are read once per part of the benchmark and never shuffled.
    """
    spark = docs.sparkSession
    out = None
    for items in _passes(bench, item_id, text):
        find = _finder(spark, items, radius, at_least)
        found = docs.select(F.col(doc_id).alias("doc_id"), F.explode(find(text)).alias("h"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.limit(0).select(F.col(doc_id).alias("doc_id"),
                                   F.explode(F.array().cast(HITS)).alias("h"))
    return out.select(F.col("doc_id").alias(doc_id),
                      F.col("h.item").cast(bench.schema[item_id].dataType).alias("item_id"),
                      "h.first_word", "h.n_words", "h.similarity")


def decontaminate(docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id",
                  radius: int = RADIUS, at_least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, with their own columns.

    Null and empty texts hold nothing and stay; rows with a null id and repeated rows are each judged by
    their text; an empty table gives no rows, an empty benchmark leaves all. Columns pass through
    under any name.
    """
    rest, first = docs, True
    for items in _passes(bench, item_id, text):
        rest = rest if first else stored(rest)
        find = _finder(docs.sparkSession, items, radius, at_least)
        rest, first = rest.filter(F.size(find(text)) == 0), False
    return rest
