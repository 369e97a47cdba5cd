"""The pipeline's stages against plain versions, each on what its predecessor kept."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from lossloom.llm import decontaminate as d
from tests.llm.test_decontaminate import plain as passage
from tests.llm.test_mixing import m as mixing
from tests.llm.test_mixing import plain as draws
from tests.llm.test_pii import plain as spans
from tests.llm.test_quality_rules import measures
from tests.llm.test_simhash import plain as fingerprint
from tests.llm.test_simhash import roots

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What every stage returned."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in cp.STAGES:
        docs = cp.stored(stage(spark, docs, SF))
        out.append(docs.collect())
    return out


def test_names_and_columns(spark, kept):
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "simhash_near_duplicates",
                                         "benchmark_decontamination", "pii", "source_mixing"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    for rows in kept[1:-1]:
        assert list(rows[0].asDict()) == columns
    assert list(kept[-1][0].asDict()) == [*columns, "epoch", "block", "n_tokens"]


def test_rules_drop_failures_and_keep_clean_documents(kept):
    ids = {r.doc_id for r in kept[1]}
    for r in kept[0]:
        words, chars, symbols, dups, repeats = measures(r.text)
        lines = max(sum(1 for x in r.text.split("\n") if x.strip(" \t\n\r\x0b\x0c")), 1)
        if words < 10 or 100 * repeats > 20 * words:
            assert r.doc_id not in ids
        elif (symbols <= 0.05 * words and dups <= 0.1 * lines and chars <= 8 * words
              and r.text.count("!") <= 0.2 * words):
            assert r.doc_id in ids


def test_one_document_of_each_class_stays(kept):
    rows = sorted(kept[1], key=lambda r: r.doc_id)
    want = roots([fingerprint(r.text) for r in rows], lambda a, b: (a ^ b).bit_count() <= 3)
    assert sorted(r.doc_id for r in kept[2]) == sorted({rows[w].doc_id for w in want})


def test_passages_go_and_clean_documents_stay(spark, kept):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    known = [set(d.tokens(t)) for t in items]
    ids = {r.doc_id for r in kept[3]}
    for r in kept[2]:
        own = set(d.tokens(r.text))
        hit = any(len(k & own) >= 0.8 * len(k) and passage(r.text, t)
                  for k, t in zip(known, items, strict=True))
        assert (r.doc_id in ids) == (not hit)


def test_personal_data_is_replaced(kept):
    before = {r.doc_id: r for r in kept[3]}
    assert len(kept[4]) == len(kept[3])
    for r in kept[4]:
        assert not spans(r.text) and r.n_chars == len(r.text)
        if not spans(before[r.doc_id].text):
            assert r.text == before[r.doc_id].text


def test_draws_follow_the_mix(kept):
    want, _ = draws([(r.doc_id, r.text, r.source) for r in kept[4]], mixing.DEFAULT)
    assert sorted(str((r.doc_id, r.source, r.epoch, r.block, r.n_tokens)) for r in kept[5]) == want


def test_run_applies_all_stages(spark, kept):
    got = cp.run(spark, SF)
    assert sorted(map(str, got.collect())) == sorted(map(str, kept[-1]))


def test_stages_take_odd_rows_and_clashing_names(spark):
    """Null ids and texts, repeats, empty tables, and columns named like those of the operators."""
    text = " ".join(f"word{k}" for k in range(40))
    rows = [(1, text, "en", "a", 3), (1, text, "en", "a", 3), (None, text + " more", None, None, None),
            (2, None, "en", "a", 0), (3, "", "en", "b", 0), (None, None, None, None, None),
            (4, "quite " + " ".join(f"other{k}" for k in range(500)) + " a@b.example", "en", "a", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = ("epoch", "block", "n_tokens", "fp", "t", "id", "n", "root", "row", "host", "place", "m",
             "component_id", "found", "words", "start", "kind", "item_id", "kept")
    docs = docs.withColumns({c: F.lit(c) for c in names})
    for frame, size in ((docs, 3), (docs.limit(0), 0)):
        for name, stage in cp.STAGES[:-1]:
            before = frame.columns
            frame = cp.stored(stage(spark, frame, SF))
            assert frame.columns == before, name
        assert frame.count() in (size, size - 1)
        last = cp.STAGES[-1][1](spark, frame, SF)
        assert set(last.columns) == set(frame.columns)
        assert (last.count() > 0) == (size > 0)
