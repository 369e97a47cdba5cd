"""Language mixtures: likelihoods against a plain version, accuracy on held-out rows."""

from collections import Counter

import numpy as np
import pytest

from lossloom.llm import language as g

DATA = "/root/testdata/sf0.01/documents.parquet"


def test_counts_match_plain_trigrams(spark):
    rows = [(1, "Ab, c!", "x", "q"), (2, None, "x", "q"), (3, "été", "y", "q"), (4, "zz", None, "q"),
            (5, "Ab, c!", "x", "q")]
    got = {(r["lang"], r["bin"]): r["n"] for r in g.count_trigrams(spark.createDataFrame(
        rows, "doc_id long, text string, lang string, bin string")).collect()}
    want = Counter()
    for _, text, lang, _ in rows:
        if text and lang:
            clean = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
            for i in range(1, len(clean) - 1):
                if clean[i] != " ":
                    want[lang, int(g.trigram_bins(clean[i - 1:i + 2].replace(" ", "1"))[
                        0 if clean[i - 1] == " " else 1])] += 1
    assert got == dict(want)


def test_mixture_finds_shares_and_set():
    r = np.random.default_rng(1)
    logs = np.log(r.dirichlet(np.full(g.BINS, 0.02), 4) + 1e-9)
    model = g.Model(["a", "b", "c", "d"], logs)
    p = np.exp(logs)
    text_bins = np.concatenate([r.choice(g.BINS, 700, p=p[1] / p[1].sum()),
                                r.choice(g.BINS, 300, p=p[3] / p[3].sum())])
    original, g.trigram_bins = g.trigram_bins, lambda t: text_bins
    try:
        lang, score, langs = model.predict("x")
        assert lang == "b" and score == pytest.approx(0.7, abs=0.05)
        assert [x for x, _ in langs] == ["b", "d"]
        text_bins = text_bins[:700]
        assert model.predict("x")[2] == [("b", 1.0)]
    finally:
        g.trigram_bins = original


def test_held_out_accuracy_and_odd_rows(spark):
    docs = spark.read.parquet(DATA)
    odd = spark.createDataFrame([(None, None, "en", None, None), (-1, "", "en", None, None),
                                 (-2, "12 34 !?", "fr", "s", 3), (-3, "a", None, "s", 3)],
                                docs.schema)
    out = g.predict_languages(docs.unionByName(odd)).toPandas()
    known = out.merge(docs.toPandas()[["doc_id", "lang"]], on="doc_id")
    held = known[known.held_out]
    assert len(held) > 100 and (held.lang_pred == held.lang).mean() > 0.97
    assert out.score.between(0, 1).all()
    at = out.set_index("doc_id").lang_pred
    assert at[-1] == at[-2] == "und" and at[-3] in set(known.lang)
    assert out[out.doc_id.isna()].lang_pred.tolist() == ["und"]


def test_empty_table_and_no_labels(spark):
    docs = spark.read.parquet(DATA)
    assert g.predict_languages(docs.limit(0)).count() == 0
    blind = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert g.predict_languages(blind).first().lang_pred == "und"
