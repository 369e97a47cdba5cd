"""Line quality: the chain against all label sequences, accuracy on held-out documents."""

from itertools import product

import numpy as np
import pytest

from lossloom.llm import line_quality as q

DATA = "/root/testdata/sf0.01"


def test_marginals_match_all_label_sequences():
    r = np.random.default_rng(2)
    chain = q.Chain(r.normal(size=(q.WIDTH, 2)), r.normal(size=(2, 2)))
    sizes = np.array([1, 4, 2, 6])
    x = r.normal(size=(sizes.sum(), q.WIDTH))
    got = chain.good(x, sizes)
    at = 0
    for n in sizes:
        e = x[at:at + n] @ chain.emission
        mass, good = 0.0, np.zeros(n)
        for y in product((0, 1), repeat=int(n)):
            w = np.exp(sum(e[i, s] for i, s in enumerate(y))
                       + sum(chain.transition[a, b] for a, b in zip(y, y[1:], strict=False)))
            mass += w
            good += w * np.array(y)
        assert got[at:at + n] == pytest.approx(good / mass)
        at += n


def test_fit_climbs_to_a_stationary_point():
    r = np.random.default_rng(3)
    sizes = np.array([3] * 60)
    x = r.normal(size=(180, q.WIDTH))
    labels = (x[:, 0] + 0.5 * r.normal(size=180) > 0).astype(int)
    chain = q.fit_chain(x, sizes, labels, q.Settings(steps=400, ridge=0.05))
    assert ((chain.good(x, sizes) > 0.5) == labels).mean() > 0.8
    assert chain.emission[0, 1] - chain.emission[0, 0] > 0.3


def test_features_of_odd_texts():
    for text in (None, "", "\n\n", "x" * 50_000, "a\n" * 5_000, "\x00 ퟿ é"):
        x, w = q.line_features(text)
        assert x.shape == ((text or "").count("\n") + 1, q.WIDTH) and np.isfinite(x).all()
        assert len(w) == len(x)
    chain = q.Chain(np.zeros((q.WIDTH, 2)), np.zeros((2, 2)))
    assert q.score_texts(chain, [None, "a\nb"]) == pytest.approx([0.5, 0.5])
    assert q.score_texts(chain, []) == []


def test_held_out_documents_and_odd_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    odd = spark.createDataFrame([(None, None, "en", None, None), (-1, "", None, None, None)],
                                docs.schema)
    more = spark.createDataFrame([(None, 1, 0), (3, None, None)], labels.schema)
    out = q.score_documents(docs.unionByName(odd), labels.unionByName(more)).toPandas()
    assert len(out) == docs.count() + 2 and out.score.between(0, 1).all()
    known = out.merge(labels.toPandas(), on="doc_id")
    held = known[known.held_out]
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert (good.predicted == 1).mean() > 0.97
    assert (bad.predicted == 0).mean() > 0.6
    assert (out.predicted == (out.score >= 0.3)).all()


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert q.score_documents(docs.limit(0), labels).count() == 0
    assert q.score_documents(docs, labels.limit(0)).first().score == 0.5
