"""Verdicts on planted tokens, most of forms that no rule names, in documents outside those learned from."""

import base64
import random
import uuid
import zlib

import pytest

from lossloom.llm import secrets as s

HEX, ALNUM = "0123456789abcdef", "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghjkmnpqrstuvwxyz23456789"


def drawn(r, n, letters=ALNUM):
    return "".join(r.choice(letters) for _ in range(n))


def planted(r):
    """(text, secret, is one, form): in ten forms."""
    words = lambda n: "_".join(r.choice(["the", "token", "goes", "here", "please", "insert",
                                         "another", "value", "there"]) for _ in range(n))
    x, name = drawn(r, 40, HEX), words(6)
    y = x if r.random() < .5 else drawn(r, 36)
    one = str(uuid.UUID(int=r.getrandbits(128)))
    text = base64.b64encode(" ".join(name.split("_")).encode()).decode()
    key, plain = drawn(r, 36), drawn(r, 16, "0123456789")
    return {
        "quoted": (f'token = "{y}"', y, True), "name": (f"calls {name} again", name, False),
        "number": (f"order {plain} shipped", plain, False),
        "env": (f"API_KEY={key}", key, True), "url": (f"https://a.b/c?token={key}&page=2", key, True),
        "header": (f"secret: {key}", key, True), "placeholder": (f'password = "{name}"', name, False),
        "hash": (f"commit {x} merged", x, False), "uuid": (f"session {one} ended", one, False),
        "base64": (f"body {text} sent", text, False)}


# Shares of the forms; only "quoted" and "placeholder" have the form that the rule calls assigned.
SHARES = {"quoted": 25, "name": 25, "number": 10, "env": 7, "url": 7, "header": 7, "placeholder": 4,
          "hash": 6, "uuid": 6, "base64": 3}


@pytest.fixture(scope="module")
def scanned(spark):
    r = random.Random(6)
    prose = "the token goes here please insert another value there and then it went on again".split()
    rows, truth = [], {}
    for i in range(1500):
        learned = zlib.crc32(str(i).encode()) % s.DEFAULT.folds != 0
        form = r.choices(list(SHARES), SHARES.values())[0] if learned else r.choice(list(SHARES))
        text, token, secret = planted(r)[form]
        around = [" ".join(r.choice(prose) for _ in range(12)) for _ in range(2)]
        rows.append((i, f"{around[0]} {text} {around[1]}", f"src/{i % 7}/main.py"))
        if not learned:
            truth[i] = (form, token, secret)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    texts = {i: t for i, t, _ in rows}
    got = {(x.doc_id, texts[x.doc_id][x.start:x.end]): x for x in s.scan(docs).collect()}
    found = s.with_features(s.candidates(docs, "doc_id", "text", "source"), s.dictionary(docs))
    rules = found.select("doc_id", "m", s.assigned_label().alias("a"), s.random_label().alias("c"))
    return truth, got, {(x.doc_id, x.m): (x.a, x.c) for x in rules.collect()}


def test_precision_and_recall_outside_the_training_fold(scanned):
    truth, got, _ = scanned
    hits = [(form, secret, got[i, token].is_secret) for i, (form, token, secret) in truth.items()]
    right = sum(a and b for _, a, b in hits)
    print({f: (sum(a == b for g, a, b in hits if g == f), sum(g == f for g, *_ in hits)) for f in SHARES})
    precision, recall = right / sum(b for *_, b in hits), right / sum(a for _, a, _ in hits)
    assert len(hits) > 200 and precision >= 0.95 and recall >= 0.95
    for form in SHARES:
        own = [a == b for f, a, b in hits if f == form]
        assert len(own) > 10 and sum(own) >= 0.9 * len(own), form


def test_forests_overturn_the_rules(scanned):
    """Placeholders that one rule calls assigned, and hashes that the other calls random."""
    truth, got, rules = scanned
    wrong = [(i, t) for i, (f, t, _) in truth.items() if f == "placeholder" and rules[i, t][0] == 1]
    wrong += [(i, t) for i, (f, t, _) in truth.items() if f == "hash" and rules[i, t][1] == 1]
    assert len(wrong) > 20 and sum(got[x].is_secret for x in wrong) <= 0.05 * len(wrong)
    unnamed = [(i, t) for i, (f, t, _) in truth.items() if f in ("env", "url", "header")]
    assert all(rules[x][0] is None for x in unnamed)
    assert sum(got[x].is_secret for x in unnamed) >= 0.9 * len(unnamed)


def test_no_forest_sees_an_input_of_its_labels():
    assert sorted(s.CHARACTERS + s.SURROUNDINGS) == sorted(s.FEATURES)
    inputs = {"assigned": "SURROUNDINGS", "quoted": "SURROUNDINGS", "keyword_before": "SURROUNDINGS",
              "digit_share": "CHARACTERS", "symbol_share": "CHARACTERS", "coverage": "CHARACTERS"}
    for rule, view in ((s.assigned_label(), "SURROUNDINGS"), (s.random_label(), "CHARACTERS")):
        for f, own in inputs.items():
            if f in str(rule):
                assert own == view
