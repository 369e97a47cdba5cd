"""Benchmark passages against every window of every document in plain Python."""

import random
from collections import Counter

import numpy as np
import pytest

from lossloom.llm import decontaminate as d


def plain(doc, item, at_least=0.8):
    """Best similarity over all windows of the item's length."""
    a, b = d.tokens(doc), d.tokens(item)
    if min(len(a), len(b)) < 5:
        return None
    want = Counter(tuple(b[i:i + 5]) for i in range(len(b) - 4))
    n = min(len(a), len(b))
    best = 0.0
    for s in range(len(a) - n + 1):
        w = a[s:s + n]
        best = max(best, d.similarity(Counter(tuple(w[i:i + 5]) for i in range(n - 4)), want))
    return best if best >= at_least else None


@pytest.fixture(scope="module")
def tables():
    r = random.Random(8)
    word = lambda: f"w{r.randrange(300)}"
    items = [" ".join(word() for _ in range(r.randrange(5, 60))) for _ in range(30)]
    items += [None, "", "one two", "a b c d e", "same same same same same same same"]
    docs = []
    for k in range(150):
        words = [word() for _ in range(r.randrange(3, 300))]
        if k % 2:
            passage = d.tokens(items[r.randrange(30)])
            passage = [x.decode() for x in passage]
            for _ in range(k % 5):
                passage[r.randrange(len(passage))] = "zz" if r.random() < .5 else "q q"
            at = r.randrange(len(words) + 1)
            words[at:at] = passage
        docs.append((" ".join(words).title() if k % 3 else "\n".join(words) + "."))
    docs += [None, "", items[0], items[1].upper() + "!!", " ".join(items[2].split()[1:]),
             "same " * 40, "a b c d e " * 3000 + items[4], " ".join(filter(None, items))]
    return docs, items


def test_passages_match_all_windows(spark, tables):
    docs, items = tables
    left = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(docs)],
                                 "doc_id long, text string, item_id string, h string")
    bench = spark.createDataFrame([(100 + i, t, 1) for i, t in enumerate(items)],
                                  "item_id long, text string, doc_id int")
    out = d.find_passages(left.repartition(4), bench).collect()
    found = {(r.doc_id, r.item_id - 100): r.similarity for r in out}
    assert len(found) == len(out)
    want = {(i, j): s for i, t in enumerate(docs) for j, u in enumerate(items)
            if (s := plain(t, u)) is not None}
    assert len(want) > 50
    assert found == pytest.approx(want)
    clean = d.decontaminate(left, bench)
    assert clean.columns == left.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(
        set(range(len(docs))) - {i for i, _ in want})


def test_parts_of_a_large_benchmark_agree(spark, tables, monkeypatch):
    docs, items = tables
    left = spark.createDataFrame([(None if i < 3 else i, t) for i, t in enumerate(docs[:60])],
                                 "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    one = sorted(map(str, d.find_passages(left, bench).collect()))
    n = d.decontaminate(left, bench).count()
    monkeypatch.setattr(d, "PASS_BYTES", 3000)
    assert sorted(map(str, d.find_passages(left, bench).collect())) == one
    assert d.decontaminate(left, bench).count() == n


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert d.find_passages(docs, bench).count() == 1
    assert d.find_passages(docs, bench.limit(0)).count() == 0
    assert d.find_passages(docs.limit(0), bench).count() == 0
    assert d.decontaminate(docs, bench.limit(0)).count() == 1
    assert d.decontaminate(docs.limit(0), bench).count() == 0


def edited(r, words, n):
    out = list(words)
    for k in r.sample(range(len(out)), n):
        out[k] = f"z{r.randrange(10 ** 6)}"
    return out


def test_tables_discard_most_items_and_keep_windows_of_similarity_08():
    """Windows of similarity 0.8 to 0.9: recall of the index; unrelated items: share looked at."""
    r = random.Random(3)
    base = [[f"w{r.randrange(5000)}" for _ in range(r.choice([60, 90, 150]))] for _ in range(200)]

    def shingles(words):
        ids = np.array([hash(w) & (1 << 40) - 1 for w in words], np.uint64)
        return d.shingle_hashes(ids)

    def print_of(words):
        h = shingles(words)
        return int(d.window_prints(h, len(h))[0])

    tables = d.BlockTables([print_of(b) for b in base], d.RADIUS)
    found = wanted = 0
    for i, words in enumerate(base):
        for n in range(1, 4):
            copy = edited(r, words, n)
            sim = d.similarity(Counter(shingles(copy).tolist()), Counter(shingles(words).tolist()))
            if .8 <= sim < .9:
                wanted += 1
                found += (0, i) in tables.near(np.array([print_of(copy)], np.uint64))
    assert wanted > 100 and found >= 0.95 * wanted
    strangers = np.array([print_of([f"s{r.randrange(5000)}" for _ in range(90)]) for _ in range(300)],
                         np.uint64)
    w, _ = tables.met(strangers)
    assert len(w) < 0.2 * 300 * len(base)
    assert len(list(tables.near(strangers))) < 0.01 * 300 * len(base)


def test_both_ways_through_the_tables_agree(monkeypatch):
    r = np.random.default_rng(5)
    prints = r.integers(0, 1 << 63, 400).astype(np.uint64)
    queries = prints[:50] ^ np.array([sum(1 << int(k) for k in r.choice(63, 19, replace=False))
                                      for _ in range(50)], np.uint64)
    want = {(w, i) for w, q in enumerate(queries.tolist()) for i, p in enumerate(prints.tolist())
            if (p ^ q).bit_count() <= 19}
    tables = d.BlockTables(prints.tolist(), 19)
    assert set(tables.near(queries)) == want and len(want) >= 50
    tables.flips, before = tables.flips[:1], tables.flips  # forces enumeration, here of one value
    assert set(zip(*map(np.ndarray.tolist, tables.met(prints[:5])), strict=True)) >= {
        (k, k) for k in range(5)}
    many = d.BlockTables(r.integers(0, 1 << 63, 4000).astype(np.uint64).tolist() + prints.tolist(), 19)
    assert len(many.prints) > len(before)
    close = {(w, i - 4000) for w, i in many.near(queries) if i >= 4000}
    assert close == want
