"""SimHash near-duplicates against all pairs in plain Python."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lossloom.llm import simhash as s
from lossloom.llm.components import connected_components


def plain(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or (
        [b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def roots(nodes, near):
    """Smallest reachable index by brute force."""
    label = list(range(len(nodes)))
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(nodes):
            for j, y in enumerate(nodes):
                if label[j] < label[i] and near(x, y):
                    label[i], changed = label[j], True
    return label


def sample():
    r = random.Random(3)
    base = [" ".join(f"w{r.randrange(4000)}" for _ in range(r.randrange(60, 200)))
            for _ in range(25)]
    texts = []
    for t in base:
        texts.append(t)
        for _ in range(r.randrange(4)):
            words = t.split()
            for _ in range(r.randrange(3)):
                words[r.randrange(len(words))] = f"x{r.randrange(100)}"
            texts.append(" ".join(words).upper() if r.random() < .3 else "\n".join(words))
    return [*texts, None, "", " \n", "one", "One two", "one two three", "é ü ñ", "Á b c", "á b c"]


@pytest.fixture(scope="module")
def texts():
    return sample()


def test_classes_match_all_pairs(spark, texts):
    docs = spark.createDataFrame([(i + 10, t, "x", "y") for i, t in enumerate(texts)],
                                 "doc_id long, text string, fp string, component_id string")
    out = {r.doc_id: r for r in s.near_duplicates(docs.repartition(5)).collect()}
    prints = [plain(t) for t in texts]
    want = roots(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    assert len(out) == len(texts)
    for i, p in enumerate(prints):
        assert out[i + 10].fingerprint == f"{p:016x}"
        assert out[i + 10].component_id == want[i] + 10
    kept = s.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({w + 10 for w in want})


def test_repeated_rows_null_ids_and_empty_table(spark, texts):
    rows = [(None, texts[0]), (5, texts[0]), (5, texts[0]), (None, "a b c d e f"),
            (None, "a b c d e f"), (7, None), (5, "quite another text here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = s.near_duplicates(docs).collect()
    assert len(out) == len(rows)
    kept = sorted((str(r.doc_id), str(r.text)) for r in s.keep_one(docs).collect())
    assert kept == sorted([("5", texts[0]), ("None", "a b c d e f"), ("7", "None"),
                           ("5", "quite another text here")])
    assert {r.component_id for r in out if r.doc_id is None} == {5, None}
    empty = docs.limit(0)
    assert s.near_duplicates(empty).count() == 0 and s.keep_one(empty).count() == 0


def test_hot_buckets_lose_no_link(spark):
    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 62, 3)
    near = {int(b) ^ sum(1 << int(k) for k in r.choice(22, r.integers(0, 6), replace=False))
            for b in base for _ in range(120)}
    nodes = sorted(near | {int(x) for x in r.integers(0, 1 << 62, 50)})
    prints = spark.createDataFrame([(x,) for x in nodes], "fp long")
    want = roots(nodes, lambda a, b: (a ^ b).bit_count() <= 3)
    for hot in (8, 10_000):
        found = {r.fp: r.root for r in s.classes(prints, hot=hot).collect()}
        assert [found.get(x, x) for x in nodes] == [nodes[w] for w in want]
        for a, b in s.links(prints, hot=hot).collect():
            assert (a ^ b).bit_count() <= 3


def test_pivot_table_never_discards_a_link(spark):
    r = np.random.default_rng(6)
    rows = []
    for x in r.integers(-(1 << 62), 1 << 62, 200):
        y = int(x) ^ s.signed(sum(1 << int(k) for k in r.choice(64, 3, replace=False)))
        rows += [(int(x), y, True), (int(x), int(r.integers(-(1 << 62), 1 << 62)), False)]
    df = spark.createDataFrame(rows, "a long, b long, linked boolean").withColumn(
        "ok", s.within_coordinates(s.pivot_table(F.col("a")), s.pivot_table(F.col("b"))))
    assert df.filter("linked and not ok").count() == 0
    assert df.filter("not linked and ok").count() < 5


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(60)]
    hub = [(1000, 1000 + i) for i in range(1, 40)]
    found = {r.node: r.root for r in connected_components(
        spark.createDataFrame([*chain, *hub, (5, 5)], "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1040), 1000)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_block_keys_cover_every_radius():
    for n in (10, 10**8, 10**12):
        keys = s.block_keys(s.blocks_for(n))
        assert all(m & sum(1 << k for k in bits) == 0 for m, bits in keys)
    assert s.blocks_for(10**6) == 5 and s.blocks_for(10**9) == 6
