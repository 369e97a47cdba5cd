"""Personal data: base spans against plain regular expressions, contexts on planted words."""

import hashlib
import re

import pytest

from lossloom.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
TEXTS = [None, "", "none here", "a@b.co, x.y+z@d-e.f.gh!", "a@b.co_x@y.zz@q.r a@b c@.d",
         "é ü 漢字 mail me@x.io now 10.0.0.255 and 10.0.0.256 or 1.2.3.4.5.6.7.8.9",
         "001.0000.255.3 0000300.1.1.1 99999999999999999999.1.1.1", "1.2.3 4.5.6.7",
         "4539 1488 0343 6467, 4539148803436467, 4539-1488-0343-6468 12345678901234567890",
         "4539 1488  0343 6467 1 2 3 4 5 6 7 8 9", "79927398713 0000000000000 00000000000000000000",
         "+1 (017) 555-7713, +12345678 and +1234567890123456 +44.20.7946.0958 + 1 +1-", "+1" * 30,
         "x" * 5000 + "@" + "y" * 5000, "9" * 6000 + " " + "1 " * 3000, "a@b.c" * 400,
         "@@@ ... +++ 1.1.1.1+1 555 0100 0200a@b.cd"]


def luhn(m):
    d = [int(c) for c in m if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
               for i, x in enumerate(d)) % 10 == 0


def plain(text):
    n = lambda m: sum(c.isdigit() for c in m)
    good = {"email": lambda m: True, "card": lambda m: 13 <= n(m) <= 19 and luhn(m),
            "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
            "phone": lambda m: 9 <= n(m) <= 15}
    return [(k, m.start(), m.end()) for k, rule in PLAIN.items()
            for m in re.finditer(rule, text or "", re.A) if good[k](m.group())]


def as_text(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(TEXTS)] + [(None, TEXTS[3], "x", "y"),
                                                             (3, TEXTS[3], "x", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, hash string")


def test_base_spans_match_plain_rules(docs):
    out = pii.digest(pii.find_pii(docs)).collect()
    assert len(out) == len(TEXTS) + 2
    for r in out:
        want = plain(TEXTS[3 if r.doc_id is None else r.doc_id])
        assert r.base_sha256 == hashlib.sha256(as_text(want).encode()).hexdigest(), r.doc_id
        assert r.spans == as_text(want)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [
            sum(s[0] == k for s in want) for k in pii.KINDS]


def test_redaction_replaces_every_base_span(docs):
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    for r in out.collect():
        text = TEXTS[3 if r.doc_id is None else r.doc_id]
        if text is None:
            assert r.text is None
            continue
        want, at = "", 0
        for k, s, e in sorted(plain(text), key=lambda x: (x[1], x[2], x[0])):
            if s >= at:
                want += text[at:s] + f"[{k.upper()}]"
            at = max(at, e)
        assert r.text == want + text[at:]


@pytest.fixture(scope="module")
def planted(spark):
    rows = [(i, f"lorem ipsum the word{i} phone: +1 555 010 {1000 + i} ends") for i in range(12)]
    rows += [(100, "please phone: 0555-010-7777 now"), (101, "the phone: 0555-010-8888 the"),
             (102, "the 0555-010-9999 is a part number"), (103, "no digits at all phone of the")]
    rows += [(200 + i, f"all of the 453914880343646{c} there") for i, c in enumerate("7")]
    rows += [(300 + i, "the " * 30 + "quiet text of the day") for i in range(20)]
    rows += [(400 + i, f"of the +1 555 020 {1000 + i} day") for i in range(6)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_contexts_discover_what_rules_miss(planted):
    out = {r.doc_id: r.spans for r in pii.digest(pii.find_pii(planted)).collect()}
    assert out[100] == "phone:14:27" and out[101] == "phone:11:24"
    assert out[102] == "" and out[103] == "" and out[300] == ""
    texts = {r.doc_id: r.text for r in pii.redact(planted).collect()}
    assert texts[100] == "please phone: [PHONE] now" and "0555" in texts[102]


def test_empty_table(planted):
    assert pii.find_pii(planted.limit(0)).count() == 0
    assert pii.redact(planted.limit(0)).count() == 0
