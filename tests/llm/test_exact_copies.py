"""Exact copies against plain grouping, with and without frequent digests."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lossloom.llm import exact_copies as e


def plain(rows):
    """Sorted (id, keep, size, sha) and the number kept per (id, sha)."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        out += [(i, best, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str), len(groups)


def sample(n, hot):
    r = random.Random(4)
    texts = [f"text {k} é" for k in range(n)]
    rows = [(i, "the hot text" if r.random() < hot else r.choice(texts)) for i in range(n)]
    rows += [(None, "the hot text"), (None, "alone"), (None, "alone"), (n + 5, None), (n + 6, ""),
             (n + 7, "Text 1 é"), (n + 7, "text 1 é "), (n + 8, "x" * 200_000)]
    return rows + [(n + 9, "again")] * 3 + [(n + 10, "the hot text")] * 2


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "r", "s") for i, t in rows],
                                 "doc_id long, text string, row string, sha string").repartition(5)


@pytest.mark.parametrize("hot", [0.0, 0.34])
def test_groups_match_plain_grouping(spark, hot):
    rows = sample(1500, hot)
    want, groups = plain(rows)
    docs = frame(spark, rows)
    out = e.judge(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out), key=str) == want
    kept = [r for r in out if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)
    left = e.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id), r.text or "") for r in left.collect()) == sorted(
        (str(r.doc_id), next(t or "" for i, t in rows if i == r.doc_id and hashlib.sha256(
            (t or "").encode()).hexdigest() == r.text_sha256)) for r in kept)


def test_summary_names_every_frequent_digest_and_counts_are_exact(spark):
    r = random.Random(1)
    rows = [(i, f"hot {i % 7}" if r.random() < .2 else f"cold {i}") for i in range(30_000)]
    docs = frame(spark, rows)
    digests = e.digest(docs, "doc_id", "text")
    found = e.frequent(digests).collect()
    want = {hashlib.sha256(f"hot {k}".encode()).digest(): [i for i, t in rows if t == f"hot {k}"]
            for k in range(7)}
    assert {bytes(x.sha): x.n for x in found} == {s: len(ids) for s, ids in want.items()}
    assert {bytes(x.sha): x.win.id for x in found} == {s: max(ids) for s, ids in want.items()}
    few = e.named(digests, counters=64, top=100).count()
    assert 7 <= few <= 64  # a small summary still names them among at most its counters


def test_one_text_holds_everything_and_empty_table(spark):
    docs = frame(spark, [(i, "same") for i in range(100)])
    out = e.judge(docs).collect()
    assert {(r.keep_id, r.group_size) for r in out} == {(99, 100)}
    assert [r.doc_id for r in out if r.kept] == [99]
    assert e.judge(docs.limit(0)).count() == 0 and e.drop_copies(docs.limit(0)).count() == 0


def test_main_path_runs_no_python_and_no_window(spark):
    docs = frame(spark, [(1, "a")])
    plan = e.judge(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Window" not in plan
    assert e.judge(docs.withColumn("doc_id", F.col("doc_id").cast("string"))).first().keep_id == "1"
