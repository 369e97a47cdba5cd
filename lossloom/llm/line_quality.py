"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features describe the line and its neighbours; the chain links the
labels of neighbouring lines. A document's score is the mean marginal probability of good lines,
weighted by line length, from one forward-backward pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log1p

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.llm.text import bucket

OWN = 14
NEIGHBOURS = (0, 3, 4, 6, 7, 8, 9)
WIDTH = OWN + 2 * len(NEIGHBOURS) + 3
_SYMBOLS = set("#*$%&|<>~^_=+{}[]\\@")


@dataclass(frozen=True)
class Settings:
    """Bound of the training sample in documents, steps and rate of the fit, ridge penalty."""
    max_train_docs: int = 3_000
    steps: int = 250
    rate: float = 0.1
    ridge: float = 1e-3


DEFAULT = Settings()


def own_features(line: str, seen: set[str]) -> list[float]:
    """What one whole line looks like; ``seen`` holds the earlier lines of the text."""
    words = line.split()
    n, chars = len(words), len(line)
    size = max(chars, 1)
    letters = sum(map(str.isalpha, line))
    upper = sum(map(str.isupper, line))
    digits = sum(map(str.isdigit, line))
    symbols = sum(line.count(c) for c in _SYMBOLS)
    repeated = line in seen and n > 0
    seen.add(line)
    pairs = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [log1p(chars) / 10, log1p(n) / 7, (sum(map(len, words)) / n / 10 if n else 0.0),
            letters / size, upper / max(letters, 1), digits / size, min(symbols / max(n, 1), 2.0),
            min(line.count("!") / max(n, 1), 2.0), len(set(words)) / n if n else 1.0,
            pairs / n if n else 0.0, float(repeated), float(n == 0),
            float(line.rstrip().endswith((".", "!", "?"))), line.count(",") / max(n, 1)]


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights) of the lines of a whole text; no text is one empty line."""
    lines = (text or "").split("\n")
    seen: set[str] = set()
    own = np.array([own_features(x, seen) for x in lines])
    near = own[:, NEIGHBOURS]
    blank = np.zeros((1, near.shape[1]))
    full = np.hstack([own, np.vstack([blank, near[:-1]]), np.vstack([near[1:], blank]),
                      np.ones((len(own), 1)), np.zeros((len(own), 2))])
    full[0, -2] = full[-1, -1] = 1.0
    return full, np.array([len(x) + 1.0 for x in lines])


@dataclass
class Chain:
    """Weights of the emissions (WIDTH x 2) and of the transitions (2 x 2)."""
    emission: np.ndarray
    transition: np.ndarray

    def pass_over(self, x: np.ndarray, sizes: np.ndarray):
        """Forward-backward over sequences laid end to end.

        Returns log alpha, log beta, emission scores and log Z per sequence. Sequences advance
        together, longest first, so a batch takes as many steps as its longest text has lines.
        """
        e = x @ self.emission
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        order = np.argsort(-sizes, kind="stable")
        first, length = starts[order], sizes[order]
        active = np.searchsorted(-length, -np.arange(length[0]), side="left")
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[first] = e[first]
        t = self.transition
        for k in range(1, length[0]):
            at = first[:active[k]] + k
            prev = alpha[at - 1]
            alpha[at] = e[at] + np.logaddexp(prev[:, :1] + t[0], prev[:, 1:] + t[1])
        for k in range(length[0] - 1, 0, -1):
            at = first[:active[k]] + k
            after = e[at] + beta[at]
            beta[at - 1] = np.logaddexp(t[:, 0] + after[:, :1], t[:, 1] + after[:, 1:])
        z = np.logaddexp(*alpha[starts + sizes - 1].T)
        return alpha, beta, e, z

    def good(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Marginal probability of good of every line."""
        alpha, beta, _, z = self.pass_over(x, sizes)
        return np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - np.repeat(z, sizes), 0.0))


def fit_chain(x: np.ndarray, sizes: np.ndarray, labels: np.ndarray,
              settings: Settings = DEFAULT) -> Chain:
    """Maximum penalised likelihood by Adam steps on the whole sample; label: a line's state."""
    n = len(sizes)
    params = np.zeros(2 * WIDTH + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    inner = np.ones(len(x), bool)
    inner[np.cumsum(sizes) - 1] = False
    left = np.flatnonzero(inner)
    truth = np.zeros((len(x), 2))
    truth[np.arange(len(x)), labels] = 1.0
    moves = np.zeros((2, 2))
    np.add.at(moves, (labels[left], labels[left + 1]), 1.0)
    for step in range(1, settings.steps + 1):
        chain = Chain(params[:2 * WIDTH].reshape(WIDTH, 2), params[2 * WIDTH:].reshape(2, 2))
        alpha, beta, e, z = chain.pass_over(x, sizes)
        per = np.repeat(z, sizes)
        gamma = np.exp(alpha + beta - per[:, None])
        after = (e + beta)[left + 1]
        joint = np.exp(alpha[left][:, :, None] + chain.transition[None] + after[:, None, :]
                       - per[left][:, None, None])
        grad = np.concatenate([(x.T @ (gamma - truth)).ravel(),
                               (joint.sum(axis=0) - moves).ravel()]) / n
        grad += settings.ridge * params
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        params = params - settings.rate * (m / (1 - 0.9 ** step)) / (
            np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Chain(params[:2 * WIDTH].reshape(WIDTH, 2), params[2 * WIDTH:].reshape(2, 2))


def training_sample(docs: DataFrame, labels: DataFrame, settings: Settings = DEFAULT,
                    doc_id: str = "doc_id", text: str = "text",
                    label: str = "quality") -> pd.DataFrame:
    """(label, x, n): line features of at most ``max_train_docs`` labelled documents.

    The documents are those with the smallest hashes of their ids. Features are made by the
    tasks that read the texts; an id labelled twice takes its mean label, rounded.
    """
    one = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("id")).agg(F.round(F.avg(label)).cast("int").alias("label"))
    sample = one.orderBy(F.xxhash64("id"), "id").limit(settings.max_train_docs)

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([line_features(t)[0].ravel() for t in texts])

    joined = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).join(
        F.broadcast(sample), "id")
    return joined.select("id", "label", features("t").alias("x")).orderBy("id").limit(
        2 * settings.max_train_docs).toPandas()


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = DEFAULT, **names) -> Chain:
    """Learn from a bounded sample; without labelled documents every line is as good as bad."""
    sample = training_sample(docs, labels, settings, **names)
    if not len(sample):
        return Chain(np.zeros((WIDTH, 2)), np.zeros((2, 2)))
    parts = [np.asarray(a).reshape(-1, WIDTH) for a in sample["x"]]
    sizes = np.array([len(p) for p in parts])
    return fit_chain(np.vstack(parts), sizes, np.repeat(sample["label"].to_numpy(int), sizes),
                     settings)


def score_texts(chain: Chain, texts: list[str | None]) -> list[float]:
    if not texts:
        return []
    parts = [line_features(t) for t in texts]
    sizes = np.array([len(w) for _, w in parts])
    good = chain.good(np.vstack([x for x, _ in parts]), sizes)
    weights = np.concatenate([w for _, w in parts])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    return (np.add.reduceat(good * weights, starts) / np.add.reduceat(weights, starts)
            ).clip(0, 1).tolist()


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
                    text: str = "text", folds: int = 5, at_least: float = 0.3,
                    settings: Settings = DEFAULT) -> DataFrame:
    """doc_id, held_out, score, predicted: a row per row of ``docs``.

    Learns from labels whose crc32 of the id modulo ``folds`` is not 0. Null and empty texts are
    one empty line; null labels teach nothing; repeated rows are scored each; an empty table
    gives no rows.
    """
    chain = fit(docs, labels.filter(bucket(doc_id, folds) != 0), settings, doc_id=doc_id, text=text)
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            values: list[float] = []
            for k in range(0, len(batch), 256):
                values += score_texts(shared.value, batch.iloc[k:k + 256].tolist())
            yield pd.Series(values, dtype="float64")

    out = docs.select(F.col(doc_id).alias("doc_id"), (bucket(doc_id, folds) == 0).alias("held_out"),
                      score(text).alias("score"))
    return out.select(F.col("doc_id").alias(doc_id), "held_out", "score",
                      F.when(F.col("score") >= at_least, 1).otherwise(0).alias("predicted"))
