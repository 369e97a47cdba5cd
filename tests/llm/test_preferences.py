"""Preference pairs against a plain Python version and SQL."""

import random

import duckdb
import pandas as pd
import pytest

from lossloom.llm import preferences as p

SCHEMA = "conv_id long, turn long, role string, text string, chosen string, __x int"


def render(turns):
    return "".join(f"<|{r or ''}|>\n{t or ''}<|end|>\n" for r, t in turns)


def runs(turns):
    out = []
    for r, t in turns:
        out += [(len(f"<|{r or ''}|>\n"), False), (len(t or "") + 8, r == "assistant")]
    return out


def plain(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return (n, render(a[:n]), render(a[n:]), render(b[n:]), runs(a[n:]), runs(b[n:]))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(9)
    out = []
    for c in range(40):
        for k in range(r.randrange(1, 7)):
            role = ["system", "user", "assistant"][0 if k == 0 and c % 4 == 0 else 1 + k % 2]
            out.append((c, k, role, r.choice(["hi", "é 漢\n", "", "same", "no"]), "z", 1))
    out += [(50, 0, "user", "x", "z", 1), (51, 1, "assistant", None, "z", 1),
            (51, 0, None, None, "z", 1), (60, 0, "user", "gap", "z", 1), (75, 0, "assistant", "far", "z", 1),
            (None, 0, "assistant", "q", "z", 1), (None, 5, "user", None, "z", 1), (52, 0, None, "t", "z", 1), (52, 0, "assistant", "t", "z", 1)]
    return [*out, out[0], out[3], (None, 0, "assistant", "q", "z", 1)]


def test_prefixes_match_plain_version(spark):
    r = random.Random(2)
    turn = lambda: (r.choice(["user", "assistant", None]), r.choice(["a", "b", None, "漢字"]))
    pairs = []
    for i in range(80):
        common = [turn() for _ in range(r.randrange(4))]
        pairs.append((i, common + [turn() for _ in range(r.randrange(3))],
                      common + [turn() for _ in range(r.randrange(3))]))
    pairs += [(100, [], []), (101, [(None, None)], []), (102, [("user", "a")] * 2000, [("user", "a")] * 1999)]
    df = spark.createDataFrame([*pairs, (103, None, None)],
                               f"id long, chosen {p.TURNS}, rejected {p.TURNS}")
    got = {r.id: tuple(r)[1:] for r in p.format_pairs(df).collect()}
    for i, a, b in [*pairs, (103, [], [])]:
        want = plain(a, b)
        assert got[i][:4] == want[:4], i
        assert [[tuple(x) for x in m] for m in got[i][4:]] == [list(want[4]), list(want[5])]
        assert sum(n for n, _ in want[4]) == len(want[2])


def test_query_matches_plain_version_and_sql(spark, rows):
    turns = spark.createDataFrame(rows, SCHEMA)
    got = p.digest(p.format_pairs(p.rejected_replies(p.conversations(turns)))).toPandas()
    conversations = pd.DataFrame([r[:4] for r in rows], columns=["conv_id", "turn", "role", "text"])  # noqa: F841
    conversations["conv_id"] = conversations.conv_id.astype("Int64")
    sql = duckdb.sql(p.oracle()).df()
    key = lambda d: sorted(map(str, d[sorted(d.columns)].astype(object).where(d.notna(), None)
                               .astype({"n_prompt_turns": int}).to_dict("records")))
    got["conv_id"], sql["conv_id"] = got.conv_id.astype("Int64"), sql.conv_id.astype("Int64")
    assert key(got) == key(sql)
    convs = {}
    for c, k, role, text, *_ in sorted(set(rows), key=lambda x: tuple(
            (v is not None, v) for v in x[:4])):
        convs.setdefault(c, []).append((role, text))
    at = got.set_index("conv_id")
    assert sum(got.conv_id.isna()) == sum(r[0] is None for r in rows)  # each a conversation
    learned = sorted(c for c, a in convs.items() if c is not None and "assistant" in dict(a))
    for c, a in convs.items():
        if c is None:
            continue
        last = max((i + 1 for i, (r, _) in enumerate(a) if r == "assistant"), default=0)
        later = [k for k in learned if k > c]
        donor = [x for x in convs[later[0]] if x[0] == "assistant"][-1:] if later else []
        want = plain(a, a if not last else a[:last - 1] + donor)
        assert tuple(at.loc[c][["n_prompt_turns", "prompt", "chosen", "rejected"]]) == want[:4]


def test_empty_table(spark, rows):
    turns = spark.createDataFrame(rows, SCHEMA).limit(0)
    assert p.format_pairs(p.rejected_replies(p.conversations(turns))).count() == 0


def test_text_ids_gaps_and_many_rows_without_an_id(spark):
    rows = [(i, k, ["user", "assistant"][k], f"{i}-{k}") for i in ("a", "c", "x9", "z") for k in (0, 1)]
    rows += [("m", 0, "user", "no reply")] + [(None, 0, "assistant", "same")] * 300
    turns = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    pairs = p.rejected_replies(p.conversations(turns.repartition(7)))
    got = {r.conv_id: r for r in pairs.filter("conv_id is not null").collect()}
    reply = {c: [x.text for x in r.rejected][-1:] for c, r in got.items()}
    assert reply == {"a": ["c-1"], "c": ["x9-1"], "m": ["no reply"], "x9": ["z-1"], "z": ["z-0"]}
    lone = pairs.filter("conv_id is null").collect()
    assert len(lone) == 300 and all(len(r.chosen) == 1 and not r.rejected for r in lone)


def test_next_ids_cross_empty_and_single_ranges(spark):
    ids = [5, 6, 7, 100, 10_000, 10**12]
    for parts in ("1", "3", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = p.next_ids(spark.createDataFrame([(i,) for i in ids], "k long"), "k").collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert {r.k: r["__ll_next"] for r in got} == dict(zip(ids, [*ids[1:], None], strict=True))


def test_columns_with_the_names_of_added_ones_are_replaced(spark):
    pairs = spark.createDataFrame([(1, "old", 7, [("user", "a")], [("user", "b")], "keep")],
                                  f"id int, prompt string, n_prompt_turns int, chosen {p.TURNS}, "
                                  f"rejected {p.TURNS}, text string")
    out = p.format_pairs(pairs)
    assert sorted(out.columns) == sorted(["id", "text", *p.ADDED])
    assert (out.first().prompt, out.first().text) == ("", "keep")
