"""Spelling variants against all pairs of words in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from lossloom.llm import spelling as s


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def plain_words(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def plain(docs):
    n = plain_words(docs)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=str)


def sample():
    r = random.Random(5)
    letters = "abcdé"
    words = ["".join(r.choice(letters) for _ in range(r.randrange(5, 9))) for _ in range(150)]
    words += ["aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "éaaaa", "Éaaaa", "ÿ×÷aaa", "x" * 3000,
              "x" * 2999, "x" * 1500 + "y" + "x" * 1499]
    for w in list(words):
        k = r.randrange(len(w))
        words += [w[:k] + w[k + 1:], w[:k] + r.choice(letters) + w[k:], w[:k] + "B" + w[k + 1:]]
    docs = [(i, " ".join(r.choices(words, weights=range(1, len(words) + 1), k=200)) + "1a_b-" + "don’tž")
            for i in range(60)]
    docs += [(100 + i, " ".join(words)) for i in range(3)]
    return [*docs, (None, docs[0][1]), (7, docs[0][1]), (7, docs[0][1]), (8, None), (9, ""),
            (10, " \n"), (11, "ab cd")]


@pytest.fixture(scope="module")
def docs():
    return sample()


@pytest.fixture(scope="module")
def want(docs):
    return plain(docs)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1) for i, t in rows],
                                 "doc_id long, text string, word string, n int").repartition(4)


@pytest.mark.parametrize("group", [s.GROUP, 40, 3])
def test_words_match_all_pairs(spark, docs, want, group):
    if group == 3:  # steps go as deep as words agree, so leave out the very long ones
        docs = [(i, t and re.sub("x{9,}[yx]*", "", t)) for i, t in docs]
        want = plain(docs)
    out = s.spelling_variants(frame(spark, docs), group=group)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == want
    assert len(want) > 100 and any(r[1] and r[1] != r[2] for r in want)


def test_composition_accepts_each_pair_once():
    r = random.Random(9)
    for size in (1, 2, 30, 200):
        words = sorted({"".join(r.choice("ab") for _ in range(r.randrange(0, 9)))
                        for _ in range(size)})
        pairs = s.composed(words)
        want = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
        assert len(pairs) == len(want)
        assert {tuple(sorted((words[i], words[j]))) for i, j in pairs} == want


def test_acceptor_is_minimal_and_numbers_words():
    words = sorted(a + b for a in ("ab", "cd", "xy") for b in ("ing", "ed", "s"))
    a = s.Acceptor(words)
    assert a.size[0] == 9
    reachable, todo = set(), [0]
    while todo:
        x = todo.pop()
        if x not in reachable:
            reachable.add(x)
            todo.extend(a.arcs[x].values())
    # Start, after each of the three first letters, before the ending, the end, and within i-n-g, e-d.
    assert len(reachable) == 1 + 3 + 1 + 1 + 3


def test_empty_table_and_no_words(spark):
    assert s.spelling_variants(frame(spark, [(1, "a b c")]).limit(0)).count() == 0
    assert s.spelling_variants(frame(spark, [(1, "short a b"), (2, None)])).count() == 0
