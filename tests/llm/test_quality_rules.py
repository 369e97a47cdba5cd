"""Quality rules against a plain Python version, odd rows included."""

import re

import pytest

from lossloom.llm import quality_rules as q

SCHEMA = "doc_id long, text string, source string, n_words string, __x int"
LONG = " ".join(f"w{i % 700}" for i in range(3000))
TEXTS = [None, "", " \t\n ", "one two", "a b c d e f g h i j k l", LONG,
         "a b c d e " * 4, "same line here\nsame line here\n\n\nsame line here\nother\v line",
         "x y z w v x y z w v q x y z w v", "# * | < > $ % & a b c", "é ü ñ ß 漢字 mot   x y",
         "p q r s t u v w x y\x0bz p q r s t", "aa aa aa aa aa aa aa aa aa aa aa"]


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, covered = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {i + k for i in at for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"host{i % 2}" if i % 3 else None, "x", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + rows[4:6] + [(None, TEXTS[8], "host1", "x", 1)], SCHEMA)


def test_measures_match_plain_version(docs):
    out = q.judge(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        text = TEXTS[8] if r.doc_id is None else TEXTS[r.doc_id]
        want = measures(text)
        assert tuple(r[c] for c in q.DIGEST) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_kept_rows_are_the_judged_ones(docs):
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns
    want = sorted(str(r.doc_id) for r in q.judge(docs).filter("kept").collect())
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_hosts_set_the_strictness(spark):
    clean = " ".join(f"word{i}" for i in range(40))
    some = clean + " # #" + " #"          # 3 symbols in 43 words: under the limit
    more = clean + " #####"               # 5 in 41: over it
    noisy = clean + " # ## ## ## ## ##"
    rows = [(i, noisy, "bad") for i in range(30)] + [(100, some, "bad"), (101, clean, "bad")]
    rows += [(200 + i, clean, "good") for i in range(3000)] + [(9000, more, "good")]
    rows += [(10_000 + i, noisy if i % 8 == 0 else clean, f"mid{i % 5}") for i in range(400)]
    rows += [(20_000, more, "mid1"), (20_001, some, "mid1")]
    out = {r.doc_id: r for r in q.judge(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[100].host_scale < 1 and out[9000].host_scale > 1 and out[20_000].host_scale == 1
    assert out[101].kept                  # clean, whatever its host
    assert out[9000].kept and not out[20_000].kept
    assert out[20_001].kept and not out[0].kept
    assert 0.3 < out[100].host_rate < 31 / 32


def test_prior_and_empty_table(spark):
    a, b = q.beta_prior(3, 300.0, 30.0, 30_000.0, 3.0)    # equal rates: the strongest prior
    assert a / (a + b) == pytest.approx(0.1) and a + b > 1000
    a, b = q.beta_prior(2, 200.0, 100.0, 20_000.0, 100.0)    # all or nothing: a weak one
    assert a + b < 1
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert q.judge(empty).count() == 0 and q.keep_good(empty).count() == 0
