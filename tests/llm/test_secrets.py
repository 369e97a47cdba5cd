"""Secret scan: candidates against a plain search, verdicts on planted tokens."""

import hashlib
import random
import re

import pytest

from lossloom.llm import secrets as s

PLAIN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}={0,2}")


def token(r, n=40, alphabet="0123456789abcdef"):
    return "".join(r.choice(alphabet) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    word = lambda k=2: "".join(r.choice(["th", "er", "ing", "on", "ti", "and", "re"]) for _ in range(k))
    out = []
    for i in range(300):
        text = [word(r.randrange(1, 4)) for _ in range(30)] + [word(8), word(9)]
        r.shuffle(text)
        if i % 3 == 0:
            text.insert(9, f'token = "{token(r)}"')
        if i % 4 == 0:
            text.insert(3, "".join(r.choice("0123456789") for _ in range(16)))
        out.append((i, " ".join(text), f"src/{i % 5}/main.py"))
    x = token(r, 40)
    return [*out, (900, f"the key is {x} for now", "a/b"), (901, None, None), (902, "", "a"),
            (903, f"é漢 {x}==, {word(8)}", None), (None, f"auth: {x}", "t"), (904, "x" * 30_000, "b"),
            out[0], out[0]]


def test_candidates_match_plain_search_and_verdicts_hold(spark, rows):
    docs = spark.createDataFrame([(*r, "q", 1) for r in rows],
                                 "doc_id long, text string, source string, m string, start int")
    got = s.scan(docs.repartition(4)).collect()
    want = sorted((str(i), m.start(), m.end(), hashlib.sha256(m.group().encode()).hexdigest())
                  for i, t, _ in rows for m in PLAIN.finditer(t or ""))
    assert sorted((str(r.doc_id), r.start, r.end, r.sha256) for r in got) == want
    texts = {i: t for i, t, _ in rows}
    for r in got:
        m = texts[r.doc_id][r.start:r.end]
        assert 0 <= r.probability <= 1 and r.is_secret == (r.probability >= 0.5)
        if r.doc_id is not None and r.doc_id < 300:
            assert r.is_secret == bool(re.search("[a-f]", m) and re.search("[0-9]", m)), m
    assert {r.is_secret for r in got if r.doc_id == 904} == {False}


def test_given_labels_one_class_and_empty_table(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plain = docs.filter("doc_id % 3 = 1 and doc_id < 300")
    assert s.scan(plain).filter("is_secret").count() == 0
    assert s.scan(docs.limit(0)).count() == 0
    found = s.with_features(s.candidates(docs, "doc_id", "text", "source"), s.dictionary(docs))
    labelled = found.withColumn("label", (s.F.col("digit_share") == 1).cast("int"))
    got = s.scan(docs, labelled=labelled).join(docs, "doc_id").collect()
    assert all(r.is_secret == r.text[r.start:r.end].isdigit() for r in got if r.doc_id < 300)


def test_dictionary_holds_trigrams_of_common_words(spark):
    docs = spark.createDataFrame([(1, "Apple apple, apple apple (apple) rare " + "xyzzy9 " * 9)],
                                 "doc_id long, text string")
    table = s.dictionary(docs)
    at = lambda g: table[((ord(g[0]) - 97) * 26 + ord(g[1]) - 97) * 26 + ord(g[2]) - 97]
    assert [at(g) for g in ("app", "ppl", "ple", "rar", "are", "xyz")] == [1, 1, 1, 0, 0, 1]
    assert sum(table) == 6
