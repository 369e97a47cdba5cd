"""A bigram language model held in a log-frequency Bloom filter.

Counts of words and word pairs are gathered over all training texts, quantised on a logarithmic
scale and stored by level: an n-gram of level q is inserted q times, with a different key each
time, so that a reader finds the level by probing 1, 2, 3, ... until a key is missing. The filter
goes to every worker; smoothed probabilities come from such probes alone.

The filter holds every word and pair of the training texts at a fixed number of bits per key, so
it grows with them. What travels does not: the filter is laid out in segments by key range, and
groups of segments of a bounded size are broadcast in turn. A token is scored in the pass that has the
segment of its pair, and a document adds up the partial sums of all passes. One or two passes read the
texts. For more, keys and word levels of all tokens are stored first, so that a pass only looks up the
pairs of its own group. No count is left out at any size.

The base score is exact: the few words that make up a fixed fraction of the text travel in a
bounded table, all others are joined.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import ceil, log, log10

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.llm.storage import stored
from lossloom.llm.text import bucket, whole, words

#: Folds A-Z to a-z and every kind of ASCII white space to a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
END, BEGIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_A, _B, _C = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xC2B2AE3D27D4EB4F))
_HALF, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)
WORD, PAIR = 1, 2
#: Training bytes behind a shard of the key range, and tokens a task gathers before it sends counts.
SHARD_BYTES, SEND_TOKENS = 12_000_000, 2_000_000
#: Bytes of text that are hashed at a time, and of segments that the driver fetches at a time.
PIECE, FETCH = 1 << 16, 8_000_000
#: Texts whose tokens are scored at a time.
TEXTS = 300


@dataclass(frozen=True)
class Settings:
    """Bytes of the segments that a pass broadcasts (of words and of pairs), bits per inserted key,
    base of the count levels, probes per key (at most 9), weight of the pair estimate, and the bound of the
    table of frequent words."""
    group_bytes: int = 64_000_000
    key_bits: float = 12.0
    base: float = 1.5
    probes: int = 5
    pair_weight: float = 0.1
    frequent_words: int = 1 << 21


DEFAULT = Settings()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class Hash:
    """Sum of table[byte] * base ** place over the bytes of a word, modulo 2 ** 64, for all words of a
    buffer at once: a difference of running sums, moved to place zero by the inverse power."""

    def __init__(self, base: int) -> None:
        self.base = base
        self.table = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))
        self.powers = self.inverse = np.ones(0, np.uint64)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.powers):
            size = max(len(data) + 1, PIECE + 1)
            for name, base in (("powers", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[:len(data)], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.inverse[starts]


class Tokens:
    """64-bit keys of the words of texts: two such sums, mixed."""

    def __init__(self) -> None:
        self.first, self.second = Hash(0x9E3779B97F4A7C15 | 3), Hash(0xD1342543DE82EF95 | 3)

    def words(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the words of the pieces, and the number of words per piece."""
        data = np.frombuffer(b" ".join([b"", *pieces, b""]), np.uint8)
        edges = np.flatnonzero(np.diff((data != 32).view(np.int8)))
        starts, ends = edges[::2] + 1, edges[1::2] + 1
        keys = mixed(self.first.words(data, starts, ends)
                     + _C * mixed(self.second.words(data, starts, ends)))
        borders = np.cumsum([1, *(len(p) + 1 for p in pieces)])
        return keys, np.diff(np.searchsorted(starts, borders))

    def keys(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Keys of all tokens, an end after each text, and the number of tokens per text."""
        found, counts, owners, held, size = [], [], [], [], 0
        for i, text in enumerate(texts):
            for piece in cut((text or "").encode().translate(_FOLD)):
                if held and size + len(piece) > PIECE:
                    k, n = self.words(held)
                    found.append(k)
                    counts.append(n)
                    held, size = [], 0
                held.append(piece)
                owners.append(i)
                size += len(piece) + 1
        if held:
            k, n = self.words(held)
            found.append(k)
            counts.append(n)
        sizes = np.ones(len(texts), np.int64)
        if owners:
            np.add.at(sizes, owners, np.concatenate(counts))
        out = np.empty(sizes.sum(), np.uint64)
        ends = np.cumsum(sizes) - 1
        inner = np.ones(len(out), bool)
        inner[ends] = False
        out[ends] = END
        if found:
            out[inner] = np.concatenate(found)
        return out, sizes


def cut(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about PIECE bytes, cut at blanks only."""
    start = 0
    while len(text) - start > PIECE:
        at = text.rfind(b" ", start, start + PIECE)
        if at <= start:
            at = text.find(b" ", start + PIECE)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def pair_keys(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Keys of (previous token, token); the first token of a text follows a begin mark."""
    return mixed(shifted(keys, sizes, BEGIN) * _C + keys)


def shifted(values: np.ndarray, sizes: np.ndarray, first) -> np.ndarray:
    """The value before each one in its text, ``first`` at the start of a text."""
    before = np.empty_like(values)
    before[1:] = values[:-1]
    before[np.concatenate(([0], np.cumsum(sizes)[:-1]))] = first
    return before


def levels(counts: np.ndarray, base: float) -> np.ndarray:
    """1 + floor(log(count)): the level of a count, 0 for none."""
    with np.errstate(divide="ignore"):
        return np.where(counts > 0, 1 + np.floor(np.log(counts) / log(base) + 1e-9), 0).astype(int)


def typical(base: float, top: int = 120) -> np.ndarray:
    """Geometric middle of the whole counts of every level; 0 for level 0."""
    low = np.ceil(np.power(base, np.arange(top)) - 1e-9)
    high = np.maximum(np.ceil(np.power(base, np.arange(1, top + 1)) - 1e-9) - 1, low)
    return np.concatenate(([0.0], np.sqrt(low * high)))


def word_and_bits(keys: np.ndarray, level: int, words: np.ndarray,
                  probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Where keys of a level lie in a segment of so many 64-bit words: one word, and the bits that are
    set in it. All probes of a key fall into one word, so a look-up fetches memory once."""
    h = mixed(keys + np.uint64(level * int(_C) & (1 << 64) - 1))
    at = (h >> _HALF) * words >> _HALF
    h = h * _B
    bits = np.zeros(len(keys), np.uint64)
    for i in range(probes):
        bits |= np.uint64(1) << (h >> np.uint64(58 - 6 * i) & np.uint64(63))
    return at, bits


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Equal parts of the key range: sorted keys give sorted shards."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def segment(keys: np.ndarray, counts: np.ndarray, key_bits: float, settings: Settings) -> bytes:
    """The filter of one shard: all its keys at all their levels."""
    q = levels(counts, settings.base)
    words = np.uint64(max(1, ceil(q.sum() * key_bits / 64)))
    table = np.zeros(words, np.uint64)
    for level in range(1, int(q.max(initial=0)) + 1):
        at, bits = word_and_bits(keys[q >= level], level, words, settings.probes)
        np.bitwise_or.at(table, at.astype(np.int64), bits)
    return table.tobytes()


@dataclass
class Filter:
    """Segments of the shards ``first``, ``first`` + 1, ... laid end to end, and where each begins (in
    words of 64 bits); keys of other shards have no level here."""
    data: np.ndarray
    begins: np.ndarray
    first: int
    shards: int
    settings: Settings

    @classmethod
    def of(cls, parts: Iterable[tuple[int, bytes]], sizes: dict[int, int], shards: int,
           settings: Settings, first: int = 0, last: int | None = None) -> Filter:
        """From (shard, segment) in any order, and the bytes of every segment; laid out in place."""
        own = range(first, shards if last is None else last + 1)
        edges = np.concatenate(([0], np.cumsum([sizes.get(s, 0) // 8 for s in own]))).astype(np.int64)
        data = np.zeros(edges[-1], np.uint64)
        for shard, part in parts:
            data[edges[shard - first]:edges[shard - first + 1]] = np.frombuffer(part, np.uint64)
        return cls(data, edges.astype(np.uint64), first, shards, settings)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        shard = shard_of(keys, self.shards) - self.first
        return (shard >= 0) & (shard < len(self.begins) - 1)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Levels by repeated membership probes; never below the true one."""
        out = np.zeros(len(keys), np.int64)
        live = np.flatnonzero(self.holds(keys))
        shard = shard_of(keys[live], self.shards) - self.first
        begin = self.begins[shard]
        words = self.begins[shard + 1] - begin
        some = words > 0
        live, begin, words = live[some], begin[some], words[some]
        left = keys[live]
        level = 0
        while len(live):
            level += 1
            at, bits = word_and_bits(left, level, words, self.settings.probes)
            hit = self.data[(begin + at).astype(np.int64)] & bits == bits
            live, left, begin, words = (v[hit] for v in (live, left, begin, words))
            out[live] = level
        return out


@dataclass
class Totals:
    """Training tokens, distinct words and texts, and the exact counts of frequent words."""
    tokens: int
    vocabulary: int
    texts: int
    frequent: np.ndarray
    counts: np.ndarray


def log_probabilities(keys: np.ndarray, sizes: np.ndarray, levels_: np.ndarray, pairs: Filter,
                      totals: Totals) -> np.ndarray:
    """log10 of the smoothed probability of every token whose pair belongs to ``pairs``; others 0."""
    s = pairs.settings
    middle = typical(s.base)
    begin = int(levels(np.array([totals.texts]), s.base)[0])
    ahead_level = shifted(levels_, sizes, begin)
    two = pair_keys(keys, sizes)
    here = np.flatnonzero(pairs.holds(two))
    own, back = np.unique(two[here], return_inverse=True)
    top = len(middle) - 1
    both = middle[np.minimum(pairs.level(own), top)][back]
    single = (middle[np.minimum(levels_[here], top)] + 1) / (totals.tokens + totals.vocabulary + 1)
    ahead = middle[np.minimum(ahead_level[here], top)]
    share = np.where(ahead > 0, np.minimum(both / np.maximum(ahead, 1), 1.0), 0.0)
    weight = np.where(ahead > 0, s.pair_weight, 0.0)
    out = np.zeros(len(keys))
    out[here] = np.log10((1 - weight) * single + weight * share)
    return out


def packed_counts(train: DataFrame, text: str, shards: int) -> DataFrame:
    """(kind, shard, keys, counts): counts of words and pairs, summed over about SEND_TOKENS
    tokens before they leave a task, as packed arrays per shard of the key range."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, held, n = Tokens(), [], 0

        def send() -> Iterator[pd.DataFrame]:
            for kind in (WORD, PAIR):
                keys, counts = np.unique(np.concatenate([h[kind - 1] for h in held]),
                                         return_counts=True)
                shard = shard_of(keys, shards)
                cuts = np.flatnonzero(np.diff(shard)) + 1
                yield pd.DataFrame({
                    "kind": kind, "shard": shard[np.concatenate(([0], cuts))],
                    "keys": [x.tobytes() for x in np.split(keys, cuts)],
                    "counts": [x.astype(np.uint32).tobytes() for x in np.split(counts, cuts)]})

        for batch in batches:
            for k in range(0, len(batch), TEXTS):
                keys, sizes = reader.keys(batch["text"].iloc[k:k + TEXTS].tolist())
                held.append((keys, pair_keys(keys, sizes)))
                n += len(keys)
                if n >= SEND_TOKENS:
                    yield from send()
                    held, n = [], 0
        if held:
            yield from send()

    return train.select(F.col(text).alias("text")).mapInPandas(
        count, "kind int, shard long, keys binary, counts binary")


def merged(packed: DataFrame, shards: int, settings: Settings) -> DataFrame:
    """(kind, shard, n, total, segment, keys, counts) per shard: the filter of its words or pairs, and
    of words the exact counts.

    A shard is a fixed part of the key range with about SHARD_BYTES of text behind it; there are as
    many tasks as shards of both kinds, so none grows with the corpus.
    """
    def merge(group: pd.DataFrame) -> pd.DataFrame:
        kind = int(group["kind"].iloc[0])
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in group["keys"]])
        parts = np.concatenate([np.frombuffer(x, np.uint32) for x in group["counts"]])
        own, at = np.unique(keys, return_inverse=True)
        counts = np.bincount(at, weights=parts, minlength=len(own)).astype(np.int64)
        word = kind == WORD
        return pd.DataFrame([{
            "kind": kind, "shard": int(group["shard"].iloc[0]), "n": len(own),
            "total": int(counts.sum()), "segment": segment(own, counts, settings.key_bits, settings),
            "keys": own.tobytes() if word else b"", "counts": counts.tobytes() if word else b""}])

    return packed.repartition(2 * shards, "kind", "shard").groupBy("kind", "shard").applyInPandas(
        merge, "kind int, shard long, n long, total long, segment binary, keys binary, counts binary")


def word_table(tables: DataFrame) -> DataFrame:
    """(key, c) of every training word."""
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, counts in zip(batch["keys"], batch["counts"], strict=True):
                yield pd.DataFrame({"key": np.frombuffer(keys, np.int64),
                                    "c": np.frombuffer(counts, np.int64)})

    return tables.filter(F.col("kind") == WORD).select("keys", "counts").mapInPandas(
        unpack, "key long, c long")


@dataclass
class Model:
    """The stored segments, their totals and the exact word table (key, c)."""
    tables: DataFrame
    shards: int
    totals: Totals
    words: DataFrame
    settings: Settings

    def sizes(self, kind: int) -> dict[int, int]:
        """Bytes of every segment: one row per shard."""
        return {r["shard"]: r["b"] for r in self.tables.filter(F.col("kind") == kind).select(
            "shard", F.octet_length("segment").alias("b")).collect()}

    def groups(self, kind: int) -> list[tuple[int, int]]:
        """(first shard, last shard) of groups of segments of at most ``group_bytes`` (or one
        segment), evenly filled."""
        size = self.sizes(kind)
        aim = sum(size.values()) / max(1, ceil(sum(size.values()) / self.settings.group_bytes))
        out, first, held = [], 0, 0
        for shard in range(self.shards):
            b = size.get(shard, 0)
            if held and (held + b > self.settings.group_bytes or held >= aim):
                out.append((first, shard - 1))
                first, held = shard, 0
            held += b
        return [*out, (first, self.shards - 1)]

    def filter(self, kind: int, group: tuple[int, int]) -> Filter:
        """The segments of one group; they reach the driver a few at a time."""
        sizes = self.sizes(kind)
        rows = self.tables.filter(F.col("kind") == kind).select("shard", "segment")

        def parts() -> Iterator[tuple[int, bytes]]:
            start, held = group[0], 0
            for shard in range(group[0], group[1] + 1):
                held += sizes.get(shard, 0)
                if held >= FETCH or shard == group[1]:
                    for r in rows.filter(F.col("shard").between(start, shard)).collect():
                        yield r["shard"], r["segment"]
                    start, held = shard + 1, 0

        return Filter.of(parts(), sizes, self.shards, self.settings, *group)


def train(docs: DataFrame, text: str = "text", settings: Settings = DEFAULT) -> Model:
    """Count all texts and build the filter. The driver gets sums and the frequent words (at most
    ``frequent_words``)."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    shards = max(1, ceil((row["b"] or 0) / SHARD_BYTES))
    tables = stored(merged(packed_counts(docs, text, shards), shards, settings))
    sums = tables.filter(F.col("kind") == WORD).agg(
        F.sum("total").alias("tokens"), F.sum("n").alias("words")).first()
    tokens = sums["tokens"] or 0
    table = word_table(tables)
    often = table.filter(F.col("c") >= frequent_count(tokens, settings)).toPandas()
    keys = often["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    totals = Totals(tokens, sums["words"] or 0, row["n"], keys[order],
                    often["c"].to_numpy(np.int64)[order])
    return Model(tables, shards, totals, table, settings)


def frequent_count(tokens: int, settings: Settings) -> int:
    """At most ``frequent_words`` words occur this often."""
    return max(1, ceil(tokens / settings.frequent_words))


def hashed(rows: DataFrame, model: Model, groups: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with ``keys`` (8 bytes per token) and ``levels`` (a byte per token) in place of the texts,
    stored: many passes then hash no text and look up no word. Words are looked up group by group."""
    @F.pandas_udf("binary")
    def to_keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Tokens()
        for texts in batches:
            made = []
            for k in range(0, len(texts), TEXTS):
                keys, sizes = reader.keys(texts.iloc[k:k + TEXTS].tolist())
                made += [x.tobytes() for x in np.split(keys, np.cumsum(sizes)[:-1])]
            yield pd.Series(made, dtype=object)

    out = stored(rows.withColumn("keys", to_keys("text")).drop("text"))
    for i, group in enumerate(groups):
        shared = rows.sparkSession.sparkContext.broadcast(model.filter(WORD, group))

        @F.pandas_udf("binary")
        def fill(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for packed, before in batches:
                made = []
                for k in range(0, len(packed), TEXTS):
                    keys, sizes = unpacked(packed.iloc[k:k + TEXTS])
                    own, at = np.unique(keys, return_inverse=True)
                    new = shared.value.level(own)[at].astype(np.uint8)  # noqa: B023
                    for part, old in zip(np.split(new, np.cumsum(sizes)[:-1]),
                                         before.iloc[k:k + TEXTS], strict=True):
                        if old is not None:
                            part = np.maximum(part, np.frombuffer(old, np.uint8))
                        made.append(part.tobytes())
                yield pd.Series(made, dtype=object)

        before = F.col("levels") if i else F.lit(None).cast("binary")
        out = stored(out.withColumn("levels", fill("keys", before)))
        shared.destroy()
    return out


def unpacked(packed: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all tokens and the number of tokens per text."""
    return (np.frombuffer(b"".join(packed), np.uint64),
            np.array([len(x) // 8 for x in packed], np.int64))


def passed(rows: DataFrame, model: Model, words: Filter | None, pairs: Filter,
           first: bool) -> DataFrame:
    """``rows`` without texts, stored, with __ll_lm of one pass: the partial sums of its pairs; in the first pass also what the base
    score needs: sums over frequent words, keys and counts of all others."""
    shared = rows.sparkSession.sparkContext.broadcast((words, pairs, model.totals))
    kind = "score double" + (", size long, base double, known long, keys array<long>, "
                             "counts array<long>" if first else "")

    def part(keys: np.ndarray, sizes: np.ndarray, known: np.ndarray | None) -> pd.DataFrame:
        words_, pairs_, totals = shared.value
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        if known is None or first:
            own, at = np.unique(keys, return_inverse=True)
        if known is None:
            known = words_.level(own)[at]
        logs = log_probabilities(keys, sizes, known, pairs_, totals)
        out = {"score": np.add.reduceat(logs, starts)}
        if not first:
            return pd.DataFrame(out)
        if len(totals.frequent):
            place = np.searchsorted(totals.frequent, own).clip(max=len(totals.frequent) - 1)
            hit = totals.frequent[place] == own
            found = hit[at]
            logs = np.where(hit, np.log10(totals.counts[place] + 1.0), 0.0)[at]
        else:
            found, logs = np.zeros(len(keys), bool), np.zeros(len(keys))
        rest = [np.unique(k[~f], return_counts=True) for k, f in zip(
            np.split(keys, starts[1:]), np.split(found, starts[1:]), strict=True)]
        return pd.DataFrame(out | {
            "size": sizes, "base": np.add.reduceat(logs, starts),
            "known": np.add.reduceat(found.astype(np.int64), starts),
            "keys": [k.view(np.int64) for k, _ in rest], "counts": [c for _, c in rest]})

    if words is None:
        @F.pandas_udf(kind)
        def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            for packed, given in batches:
                yield pd.concat([part(*unpacked(packed.iloc[k:k + TEXTS]), np.frombuffer(
                    b"".join(given.iloc[k:k + TEXTS]), np.uint8).astype(np.int64))
                    for k in range(0, len(packed), TEXTS)], ignore_index=True)
        lm = score("keys", "levels")
    else:
        @F.pandas_udf(kind)
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            reader = Tokens()
            for texts in batches:
                yield pd.concat([part(*reader.keys(texts.iloc[k:k + TEXTS].tolist()), None)
                                 for k in range(0, len(texts), TEXTS)], ignore_index=True)
        lm = score("text")
    out = stored(rows.withColumn("__ll_lm", lm).drop("text", "keys", "levels"))
    shared.destroy()
    return out


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7,
                    held: int = 2, settings: Settings = DEFAULT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row per row.

    Learns from rows whose crc32 of the id modulo ``folds`` is not ``held``. Null and empty texts
    are one end token; repeated rows count and are scored each; without training rows every
    token has probability one; an empty table gives no rows. Word keys are 64-bit hashes.
    """
    out = docs.select(F.col(doc_id).alias("doc_id"), (bucket(doc_id, folds) == held).alias("held_out"),
                      F.col(text).alias("text"))
    model = train(out.filter(~F.col("held_out")), "text", settings)
    word_groups, pair_groups = model.groups(WORD), model.groups(PAIR)
    numbered = out.withColumn("rid", F.monotonically_increasing_id())
    if len(word_groups) > 1 or len(pair_groups) > 2:
        numbered, words_ = hashed(numbered, model, word_groups), None
    else:
        words_ = model.filter(WORD, word_groups[0])
        if len(pair_groups) > 1:
            numbered = stored(numbered)  # both passes must see the same numbers
    rows = passed(numbered, model, words_, model.filter(PAIR, pair_groups[0]), True)
    lm = F.col("__ll_lm")
    more = None
    for group in pair_groups[1:]:
        one = passed(numbered.drop("doc_id", "held_out"), model, words_,
                     model.filter(PAIR, group), False).select("rid", lm["score"].alias("part"))
        more = one if more is None else more.unionByName(one)
    # Words below the frequent ones: no key has more than a fixed fraction of the tokens, so the
    # join is even; the sums of a document combine again before they meet.
    rare = rows.select("rid", F.explode(F.arrays_zip(lm["keys"].alias("key"),
                                                     lm["counts"].alias("n"))).alias("r"))
    counts = model.words.filter(F.col("c") < frequent_count(model.totals.tokens, settings))
    sums = rare.select("rid", "r.key", "r.n").join(counts, "key").groupBy("rid").agg(
        F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("base"), F.sum("n").alias("known"))
    scale = log10(model.totals.tokens + model.totals.vocabulary + 1)
    scored = rows.join(sums, "rid", "left")
    total = lm["score"]
    if more is not None:
        scored = scored.join(more.groupBy("rid").agg(F.sum("part").alias("more")), "rid")
        total = total + F.col("more")
    return scored.select(
        F.col("doc_id").alias(doc_id), "held_out", lm["size"].alias("n_tokens"),
        (lm["known"] + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.totals.tokens).cast("long").alias("train_tokens"),
        (lm["base"] + F.coalesce("base", F.lit(0.0)) - lm["size"] * F.lit(scale)).alias("base_score"),
        total.alias("score"))
