"""Languages of a document as a mixture.

Each language is a distribution over letter trigrams, counted over all labelled training texts
and hashed to a fixed number of bins. A document is a mixture of languages: expectation
maximisation estimates the proportions from the trigram likelihoods, and the set of languages is
the one with the best likelihood after a penalty per extra language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.llm.text import bucket

BINS = 1 << 14
UNKNOWN = "und"
RESULT = "lang string, score double, langs array<struct<lang:string,share:double>>"
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@dataclass(frozen=True)
class Settings:
    """Smoothing per bin, rounds of EM, weight of the penalty (1: half a log of the trigrams)."""
    smoothing: float = 0.5
    rounds: int = 20
    penalty: float = 1.0


DEFAULT = Settings()


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigram_bins(text: str | None) -> np.ndarray:
    """Bin of the trigram around every letter; all other characters count as one space."""
    if not text:
        return np.zeros(0, np.int64)
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    letter = _letters()[points]
    c = np.where(letter, points, 32).astype(np.uint64)
    h = c[:-2] * _MIX[0] + c[1:-1] * _MIX[1] + c[2:] * _MIX[2]
    h = h[letter[1:-1]]
    return ((h ^ (h >> np.uint64(31))) * _MIX[0] >> np.uint64(50)).astype(np.int64)


def count_trigrams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bin, n) over all rows with a language: each task sends at most BINS rows per
    language, whatever it has read."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, t in zip(batch["lang"], batch["text"], strict=True):
                own = totals.setdefault(name, np.zeros(BINS, np.int64))
                own += np.bincount(trigram_bins(t), minlength=BINS)
        for name, own in totals.items():
            at = np.flatnonzero(own)
            yield pd.DataFrame({"lang": name, "bin": at, "n": own[at]})

    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    return rows.mapInPandas(count, "lang string, bin long, n long").groupBy("lang", "bin").agg(
        F.sum("n").alias("n"))


@dataclass
class Model:
    """Log probabilities, a row per language; its size is languages x BINS, not the corpus."""
    langs: list[str]
    logs: np.ndarray

    def predict(self, text: str | None, settings: Settings = DEFAULT):
        """(language, its share, [(language, share)] of the chosen set)."""
        bins = trigram_bins(text)
        if not len(bins) or not self.langs:
            return UNKNOWN, 0.0, []
        at, n = np.unique(bins, return_counts=True)
        logs = self.logs[:, at]
        top = logs.max(axis=0)
        p = np.exp(logs - top)
        share, _ = proportions(p, n, settings.rounds)
        order = np.argsort(-share, kind="stable")
        single = logs @ n
        first = int(np.argmax(single))
        order = np.concatenate(([first], order[order != first]))
        best = (float(single[first] - top @ n), [first], np.ones(1))
        cost = settings.penalty * 0.5 * np.log(n.sum())
        for k in range(2, len(order) + 1):
            chosen = order[:k]
            share, fit = proportions(p[chosen], n, settings.rounds)
            value = fit - (k - 1) * cost
            if value <= best[0]:
                break
            best = (value, list(chosen), share)
        langs = sorted(zip(best[2].tolist(), best[1], strict=True), key=lambda x: (-x[0], x[1]))
        return (self.langs[langs[0][1]], langs[0][0],
                [(self.langs[i], s) for s, i in langs])


def proportions(p: np.ndarray, n: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """EM for the mixture weights of the rows of ``p``; weights and log likelihood."""
    w = np.full(len(p), 1 / len(p))
    for _ in range(rounds):
        mix = np.maximum(w @ p, 1e-300)
        w = w * (p @ (n / mix)) / n.sum()
    return w, float(n @ np.log(np.maximum(w @ p, 1e-300)))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang",
        settings: Settings = DEFAULT) -> Model:
    """Learn from every row with a language; only the table of bins reaches the driver."""
    counts = count_trigrams(docs, text, lang).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.zeros((len(langs), BINS))
    rows = counts["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)
    table[rows, counts["bin"].to_numpy(np.int64)] = counts["n"].to_numpy()
    table += settings.smoothing
    return Model(langs, np.log(table / table.sum(axis=1, keepdims=True)))


def identify(docs: DataFrame, model: Model, text: str = "text",
             settings: Settings = DEFAULT) -> Column:
    """Struct (lang, score, langs) of each whole text; ``und`` without a letter."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = [shared.value.predict(t, settings) for t in batch]
            yield pd.DataFrame({"lang": [r[0] for r in rows], "score": [r[1] for r in rows],
                                "langs": [[{"lang": x, "share": s} for x, s in r[2]]
                                          for r in rows]})

    return predict(F.col(text))


def predict_languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      lang: str = "lang", folds: int = 5,
                      settings: Settings = DEFAULT) -> DataFrame:
    """doc_id, held_out, lang_pred, score, langs: a row per row of ``docs``.

    Learns from rows whose crc32 of the id modulo ``folds`` is not 0. Null languages teach
    nothing; null texts and texts without a letter are ``und`` with score 0; repeated rows count
    and are answered each; an empty table gives no rows.
    """
    held = bucket(doc_id, folds) == 0
    model = fit(docs.filter(~held), text, lang, settings)
    out = docs.select(F.col(doc_id).alias("doc_id"), held.alias("held_out"),
                      identify(docs, model, text, settings).alias("p"))
    return out.select(F.col("doc_id").alias(doc_id), "held_out", F.col("p.lang").alias("lang_pred"),
                      F.col("p.score").alias("score"), F.col("p.langs").alias("langs"))
