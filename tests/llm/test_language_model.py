"""The Bloom language model against exact counts in plain Python."""

import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from lossloom.llm import language_model as lm

DATA = "/root/testdata/sf0.001/documents.parquet"


def tokens(text):
    return [*(text or "").encode().translate(lm._FOLD).split(), None]


def plain(rows):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    count = Counter(w for (_, t), h in zip(rows, held, strict=True) if not h for w in tokens(t))
    n, v = count.total(), len(count)
    out = []
    for (i, t), h in zip(rows, held, strict=True):
        own = tokens(t)
        out.append((i, h, len(own), sum(count[w] > 0 for w in own), n,
                    sum(log10((count[w] + 1) / (n + v + 1)) for w in own)))
    return out, count


@pytest.fixture(scope="module")
def rows(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(DATA).collect()]
    return [*docs, (None, "The THE the"), (-5, None), (-6, ""), (-7, "É é\x0bx\x0c y"), docs[3], docs[3],
            (-8, "zebra " * 9_000)]


def scores(spark, rows, settings=lm.DEFAULT):
    docs = spark.createDataFrame([(*r, "a", 1) for r in rows],
                                 "doc_id long, text string, size string, rid int")
    return lm.score_documents(docs.repartition(5), settings=settings).collect()


@pytest.mark.parametrize("frequent", [1 << 21, 50])
def test_exact_columns_match_plain_counts(spark, rows, frequent):
    want, _ = plain(rows)
    got = scores(spark, rows, lm.Settings(frequent_words=frequent))
    assert len(got) == len(rows)
    key = lambda r: (str(r[0]), r[2])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and np.isfinite(g[6]) and g[6] < 0


def test_model_beats_the_base_on_copies_and_stays_close_elsewhere(spark, rows):
    got = [r for r in scores(spark, rows) if r.held_out and r.n_tokens > 50]
    gain = [(r.score - r.base_score) / r.n_tokens for r in got]
    assert min(gain) > -0.25 and np.mean(gain) > -0.1


def test_filter_returns_levels_and_errs_upwards_only():
    r = np.random.default_rng(4)
    keys = np.unique(r.integers(0, 1 << 63, 20_000).astype(np.uint64) * np.uint64(2))
    counts = np.maximum(1, (r.pareto(1.0, len(keys)))).astype(np.int64)
    s = lm.DEFAULT
    shard = lm.shard_of(keys, 3)
    parts = [(k, lm.segment(keys[shard == k], counts[shard == k], 12.0, s)) for k in range(3)]
    sizes = {k: len(p) for k, p in parts}
    f = lm.Filter.of(parts, sizes, 3, s)
    true, got = lm.levels(counts, s.base), f.level(keys)
    assert (got >= true).all() and (got == true).mean() > 0.98
    assert (f.level(keys + np.uint64(1)) > 0).mean() < 0.02
    middle = lm.typical(s.base)
    assert (np.abs(np.log(middle[true] / counts)) <= np.log(s.base)).all()
    assert lm.Filter.of([], {}, 3, s).level(keys[:5]).tolist() == [0] * 5
    one = lm.Filter.of(parts[1:2], sizes, 3, s, 1, 1)
    assert (one.level(keys) == np.where(shard == 1, got, 0)).all() and (one.holds(keys) == (shard == 1)).all()


def plain_scores(rows, s=lm.DEFAULT):
    """The model in plain Python: exact counts rounded to the middle of their level."""
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    learned = [tokens(t) for (_, t), h in zip(rows, held, strict=True) if not h]
    words = Counter(w for own in learned for w in own)
    pairs = Counter(p for own in learned for p in zip(["begin", *own], own, strict=False))
    words["begin"] = len(learned)
    total = sum(map(len, learned))
    seen = len(words) - 1

    def rounded(c):
        if not c:
            return 0.0
        level = int(np.floor(np.log(c) / np.log(s.base) + 1e-9))
        low = int(np.ceil(s.base ** level - 1e-9))
        return (low * max(int(np.ceil(s.base ** (level + 1) - 1e-9)) - 1, low)) ** .5

    out = []
    for _, t in rows:
        own, score = tokens(t), 0.0
        for h, w in zip(["begin", *own], own, strict=False):
            p, ahead = (rounded(words[w]) + 1) / (total + seen + 1), rounded(words[h])
            if ahead:
                share = min(rounded(pairs[h, w]) / ahead, 1.0)
                p = (1 - s.pair_weight) * p + s.pair_weight * share
            score += log10(p)
        out.append(score)
    return out


def test_scores_match_a_plain_model_in_one_pass_and_in_many(spark, rows, monkeypatch):
    """With so many bits a key that no probe errs, scores are those of the quantised counts."""
    monkeypatch.setattr(lm, "SHARD_BYTES", 60_000)
    want = sorted(zip([str(i) for i, _ in rows], map(len, map(tokens, [t for _, t in rows])),
                      plain_scores(rows), strict=True))
    for s in (lm.Settings(key_bits=640.0, probes=9),
              lm.Settings(key_bits=640.0, probes=9, group_bytes=2_000_000)):
        got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in scores(spark, rows, s))
        for g, w in zip(got, want, strict=True):
            assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], rel=1e-9)


def test_ordinary_bits_change_scores_little(spark, rows):
    got = {(str(r.doc_id), r.n_tokens): r.score / r.n_tokens for r in scores(spark, rows)}
    gaps = [abs(got[str(i), len(tokens(t))] - w / len(tokens(t)))
            for (i, t), w in zip(rows, plain_scores(rows), strict=True)]
    assert np.mean(gaps) < 0.005 and np.quantile(gaps, .9) < 0.01  # log10 per token


def test_every_pass_is_bounded_and_nothing_is_left_out(spark, rows, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_BYTES", 20_000)
    s = lm.Settings(group_bytes=50_000)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm.train(docs, settings=s)
    words = Counter(w for _, t in rows for w in tokens(t))
    pairs = {p for _, t in rows for p in zip([0, *tokens(t)], tokens(t), strict=False)}
    assert (model.totals.tokens, model.totals.vocabulary) == (words.total(), len(words))
    stored = {r["kind"]: r["n"] for r in model.tables.groupBy("kind").sum("n").toDF(
        "kind", "n").collect()}
    assert stored == {lm.WORD: len(words), lm.PAIR: len(pairs)}
    for kind in (lm.WORD, lm.PAIR):
        groups = model.groups(kind)
        assert [a for a, _ in groups[1:]] == [b + 1 for _, b in groups[:-1]]
        assert (groups[0][0], groups[-1][1]) == (0, model.shards - 1)
        assert all(model.filter(kind, g).data.nbytes <= s.group_bytes for g in groups)
    assert len(model.groups(lm.PAIR)) >= 3


def test_keys_do_not_depend_on_how_texts_are_cut(monkeypatch):
    texts = ["One two", None, "", "a" * 50 + " b " * 40, " x\ty\x0bz ", "é ü Å", "x" * 300]
    want = lm.Tokens().keys(texts)
    for piece in (7, 64):
        monkeypatch.setattr(lm, "PIECE", piece)
        got = lm.Tokens().keys(texts)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    assert want[1].tolist() == [len(tokens(t)) for t in texts]
    flat = [w for t in texts for w in tokens(t)]
    assert len({*zip(flat, want[0].tolist(), strict=True)}) == len(set(flat)) == len(set(want[0].tolist()))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(0, "a b")], "doc_id long, text string")
    assert lm.score_documents(docs.limit(0)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    only = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    r = lm.score_documents(only).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
