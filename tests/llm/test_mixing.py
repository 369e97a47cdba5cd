"""Mixing against the same rules in plain Python and in SQL."""

import hashlib
from math import ceil, log, sqrt

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lossloom.llm import mixing as m

MIX = m.Mix(entropy=0.9, max_repeats=3.0)


def rows():
    out = [(i, "w " * (1 + i * 7 % 40), "big") for i in range(300)]
    out += [(1000 + i, "w\n" * (5 + i % 9), f"small{i % 4}") for i in range(60)]
    out += [(2000 + i, "x y z", None) for i in range(10)]
    out += [(3000, None, "big"), (3001, "", "small1"), (3002, " \t", "hollow"), (3003, "a", "tiny")]
    return out


def plain(rows, mix):
    size = [len((t or "").split()) for _, t, _ in rows]
    total = {}
    for (_, _, s), n in zip(rows, size, strict=True):
        total[s] = total.get(s, 0) + n
    total = {s: n for s, n in total.items() if n}
    everything = sum(total.values())
    p = {s: n / everything for s, n in total.items()}

    def fits(a):
        z = sum(x ** a for x in p.values())
        w = [x ** a / z for x in p.values()]
        repeats = max(x ** (a - 1) for x in p.values()) / z
        return (-sum(x * log(x) for x in w) <= mix.entropy * log(len(p)) + 1e-12
                and repeats <= mix.max_repeats + 1e-12)

    low, high = 0.0, 1.0
    for _ in range(30):
        mid = (low + high) / 2
        low, high = (low, mid) if fits(mid) else (mid, high)
    z = sum(x ** high for x in p.values())
    out = []
    for s in total:
        target = round(p[s] ** high / z * everything)
        own = [(r, n) for r, n in zip(rows, size, strict=True) if r[2] == s]
        blocks = ceil(sqrt(len(own)))
        epochs, rest = divmod(target, total[s])
        for e in range(epochs + 1):
            placed = []
            for (i, t, _), n in own:
                at = hashlib.md5(f"{mix.seed}|{e}|{i}".encode()).hexdigest()
                at += hashlib.md5((t or "").encode()).hexdigest()
                placed.append((int(at[:12], 16) % blocks, at, i, n))
            used = 0
            for b, _, i, n in sorted(placed):
                used += n
                if e < epochs or used <= rest:
                    out.append((i, s, e, b, n))
    return sorted(map(str, out)), high


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 7, "q") for r in rows()],
                                 "doc_id long, text string, source string, block int, place string")


def test_draws_match_plain_version_and_sql(docs):
    want, a = plain(rows(), MIX)
    assert 0 < a < 1
    got = m.mixed(docs, MIX).collect()
    assert sorted(str(tuple(r)) for r in got) == want
    documents = pd.DataFrame(rows(), columns=["doc_id", "text", "source"])  # noqa: F841
    sql = duckdb.sql(m.oracle(MIX)).df()
    assert sorted(zip(sql.doc_id, sql.epoch, sql.block, strict=True)) == sorted(
        (r.doc_id, r.epoch, r.block) for r in got)
    full = m.draw(docs.drop("block"), MIX)
    assert full.columns == ["doc_id", "text", "source", "place", "epoch", "block", "n_tokens"]
    assert sorted(str((r.doc_id, r.source, r.epoch, r.block, r.n_tokens))
                  for r in full.collect()) == want


def test_targets_hold(docs):
    got = m.mixed(docs, MIX).toPandas()
    have = docs.toPandas().assign(n=lambda d: d.text.fillna("").str.split().str.len())
    used = got.groupby("source", dropna=False).n_tokens.sum()
    there = have.groupby("source", dropna=False).n.sum()
    assert all(used[s] <= 3.0 * there[s] + 1 for s in used.index)
    assert used.sum() <= there.sum()
    assert "hollow" not in set(got.source)


def test_repeats_bind_and_budgets_differ(docs):
    want, _ = plain(rows(), m.Mix(entropy=1.0, max_repeats=1.5))
    got = m.mixed(docs, m.Mix(entropy=1.0, max_repeats=1.5)).collect()
    assert sorted(str(tuple(r)) for r in got) == want
    small = m.mixed(docs, m.Mix(tokens=500)).toPandas()
    assert 0 < small.n_tokens.sum() <= 500


def test_repeated_rows_null_ids_and_empty_table(spark, docs):
    twice = spark.createDataFrame([(1, "a b", "s"), (1, "a b", "s"), (None, "c", "s"),
                                   (None, "c", "s"), (2, "d", None)],
                                  "doc_id long, text string, source string")
    assert m.mixed(twice, m.Mix(max_repeats=1.0)).count() == 5
    assert m.draw(twice, m.Mix(max_repeats=1.0)).count() == 5
    assert m.mixed(docs.limit(0)).count() == 0 and m.draw(docs.limit(0)).count() == 0


def test_columns_with_the_names_of_added_ones_are_replaced(docs):
    named = docs.withColumns({"epoch": F.lit("old"), "block": F.lit("old"), "n_tokens": F.lit("old"),
                              "place": F.lit("mine"), "weight": F.lit("mine")})
    got, want = m.draw(named), m.draw(docs)
    assert sorted(got.columns) == sorted([*want.columns, "weight"])
    rest = [c for c in want.columns if c != "place"]
    assert sorted(map(str, got.select(*rest).collect())) == sorted(map(
        str, want.select(*rest).collect()))
    assert {(r.place, r.weight) for r in got.collect()} == {("mine", "mine")}
