"""Spelling variants: words one edit apart, by composing the vocabulary with itself.

The vocabulary is a minimised acceptor A. A ∘ E ∘ A, with a transducer E that copies all code
points but one (which it inserts, deletes or replaces), accepts exactly the pairs one edit apart.
Before the edit both sides read the same prefix, so they are in one state of A; after it they only
copy, so the rest must be accepted from both states.

The composition is cut by its initial states. The state after a prefix holds all words with that
prefix; one that holds at most ``GROUP`` words is an initial state of its own: a task builds the
minimised acceptor of what follows and enumerates the pairs. A larger one is taken one step:
its words go on to the states of the next code point, and the edit made at this very step leaves
two states that must accept one same rest, so words meet by prefix and rest. At most one word per
letter of the alphabet can meet so. Every pair is found once, at the place where its words
first differ; no group is larger than GROUP or the alphabet.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.llm.storage import join_on_hot_key, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Words of one initial state.
GROUP = 20_000
#: Distinct words a task counts before it sends them on.
SEND = 300_000
TYPO, LEAST_LENGTH, LEAST_COUNT, FACTOR = 97, 5, 3, 2


def altered(run: str, doc_crc: int) -> str:
    """The run without one code point if 97 divides the hash of document and run."""
    h = zlib.crc32(run.encode(), doc_crc)
    if h % TYPO:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def counted(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(word, n): occurrences of the words of all whole texts, added up inside the tasks first."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, int] = {}
        for batch in batches:
            for name, body in zip(batch["id"], batch["text"], strict=True):
                start = zlib.crc32(f"{name}:".encode())
                runs = RUN.findall(body.encode().translate(LOWER).decode())
                for run, n in Counter(runs).items():
                    word = altered(run, start)
                    if len(word) >= LEAST_LENGTH:
                        held[word] = held.get(word, 0) + n
                if len(held) >= SEND:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held = {}
        yield pd.DataFrame({"word": pd.Series(list(held), dtype="str"),
                            "n": pd.Series(list(held.values()), dtype="int64")})

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
                       F.col(text).alias("text")).filter(F.col("text").isNotNull())
    return rows.mapInPandas(count, "word string, n long")


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words with enough code points and occurrences, stored."""
    return stored(counted(docs, doc_id, text).groupBy("word").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= LEAST_COUNT))


class Acceptor:
    """Minimised acceptor of sorted distinct words; states know how many words follow them, so a
    path is also the number of its word."""

    def __init__(self, words: list[str]) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        self.size = [0]
        self.steps: list[list[tuple[str, int, int]]] = [[]]
        self._known: dict[tuple, int] = {}
        self._free: list[int] = []
        path, last = [0], ""
        for word in words:
            same = 0
            for a, b in zip(last, word, strict=False):
                if a != b:
                    break
                same += 1
            self._close(path, last, same)
            for c in word[same:]:
                state = self._new()
                self.arcs[path[-1]][c] = state
                path.append(state)
            self.final[path[-1]] = True
            last = word
        self._close(path, last, 0)
        self._finish(0)

    def _new(self) -> int:
        if self._free:
            state = self._free.pop()
            self.arcs[state], self.final[state] = {}, False
            return state
        for column, value in ((self.arcs, {}), (self.final, False), (self.size, 0), (self.steps, [])):
            column.append(value)
        return len(self.arcs) - 1

    def _close(self, path: list[int], word: str, keep: int) -> None:
        """Replace the states of the last word beyond ``keep`` by equal ones that are known."""
        while len(path) > keep + 1:
            state = path.pop()
            kind = (self.final[state], tuple(self.arcs[state].items()))
            known = self._known.get(kind)
            if known is None:
                self._known[kind] = state
                self._finish(state)
            else:
                self.arcs[path[-1]][word[len(path) - 1]] = known
                self._free.append(state)

    def _finish(self, state: int) -> None:
        """Offsets of the words behind each arc; arcs are in order, since words are."""
        n, steps = int(self.final[state]), []
        for c, to in self.arcs[state].items():
            steps.append((c, to, n))
            n += self.size[to]
        self.size[state], self.steps[state] = n, steps


def common(a: Acceptor, s: int, t: int, u: int, v: int, out: list[tuple[int, int]]) -> None:
    """Append the words that go on alike from states ``s`` and ``t``, as numbers from u and v."""
    todo = [(s, t, u, v)]
    while todo:
        s, t, u, v = todo.pop()
        if s == t:
            out.extend((u + k, v + k) for k in range(a.size[s]))
            continue
        if a.final[s] and a.final[t]:
            out.append((u, v))
        other = a.arcs[t]
        if not other:
            continue
        offsets = None
        for c, to, off in a.steps[s]:
            if c in other:
                if offsets is None:
                    offsets = {d: o for d, _, o in a.steps[t]}
                todo.append((to, other[c], u + off, v + offsets[c]))


def composed(words: list[str]) -> list[tuple[int, int]]:
    """Numbers of the pairs of sorted distinct words that A ∘ E ∘ A accepts, each once."""
    a, out = Acceptor(words), []
    todo = [(0, 0)]
    while todo:
        s, u = todo.pop()
        steps = a.steps[s]
        todo.extend((to, u + off) for _, to, off in steps)
        if len(steps) == 1 and not a.final[s]:
            continue
        for i, (c, to, off) in enumerate(steps):
            for _, other, beyond in steps[i + 1:]:
                common(a, to, other, u + off, u + beyond, out)  # one code point for another
            if a.final[s] and a.final[to]:  # c inserted, then what follows s but not by c
                out.append((u, u + off))
            longer = a.arcs[to]
            for d, next_, beyond in steps:
                if d != c and d in longer:
                    inner = next(o for e, _, o in a.steps[to] if e == d)
                    common(a, next_, longer[d], u + beyond, u + off + inner, out)
    return out


def compose(group: pd.DataFrame) -> pd.DataFrame:
    """Pairs of one initial state: columns a, n_a, b, n_b."""
    rows = sorted(zip(group["word"], group["n"], strict=True))
    step = int(group["step"].iloc[0])
    pairs = composed([w[step:] for w, _ in rows])
    i, j = ([p[k] for p in pairs] for k in (0, 1))
    return pd.DataFrame({"a": pd.Series([rows[k][0] for k in i], dtype="str"),
                         "n_a": pd.Series([rows[k][1] for k in i], dtype="int64"),
                         "b": pd.Series([rows[k][0] for k in j], dtype="str"),
                         "n_b": pd.Series([rows[k][1] for k in j], dtype="int64")})


def edited_here(words: DataFrame, step: int) -> DataFrame:
    """Pairs (a, n_a, b, n_b) of words (prefix, word, n) whose edit is at ``step``: their next code
    points differ, and the rest is the same with or without it."""
    next_ = F.substring("word", step + 1, 1)
    without = F.struct(F.substring("word", step + 2, 1 << 30).alias("rest"))
    whole = F.struct(F.substring("word", step + 1, 1 << 30).alias("rest"))
    both = words.withColumn("next", next_).withColumn(
        "e", F.explode(F.when(F.col("next") == "", F.array(whole)).otherwise(
            F.array(without, whole))))
    met = both.groupBy("prefix", "e.rest").agg(F.collect_list(F.struct("next", "word", "n")).alias(
        "w")).filter(F.size("w") > 1)
    a, b = F.col("a"), F.col("b")
    return met.withColumn("a", F.explode("w")).withColumn("b", F.explode("w")).filter(
        (a["next"] < b["next"])).select(
        a["word"].alias("a"), a["n"].alias("n_a"), b["word"].alias("b"), b["n"].alias("n_b"))


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(a, n_a, b, n_b): every pair of ``words`` (word, n) one edit apart, once, stored."""
    left, found, small, step = words.select("word", "n"), [], [], 0
    while True:
        left = left.withColumn("prefix", F.substring("word", 1, step))
        sizes = left.groupBy("prefix").agg(F.count(F.lit(1)).alias("size"))
        large = stored(sizes.filter(F.col("size") > group))
        last = large.isEmpty()
        cut = left if last else stored(join_on_hot_key(left, large, "prefix", "word"))
        own = cut if last else cut.filter("size is null")
        small.append(own.select(F.lit(step).alias("step"), "prefix", "word", "n"))
        if last:
            break
        left = cut.filter("size is not null").drop("size")
        found.append(edited_here(left, step))
        step += 1
        left = left.filter(F.length("word") >= step)
    parts = small[0]
    for more in small[1:]:
        parts = parts.unionByName(more)
    pairs = parts.groupBy("step", "prefix").applyInPandas(
        compose, "a string, n_a long, b string, n_b long")
    for more in found:
        pairs = pairs.unionByName(more)
    return stored(pairs)


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of largest n, if it is frequent enough."""
    ways = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"),
                            F.col("n_b").alias("m")),
                   F.struct(F.col("b").alias("word"), F.col("a").alias("near"),
                            F.col("n_a").alias("m")))
    per = pairs.select(F.explode(ways).alias("w")).select("w.*").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("m"), F.col("near"))).alias("best"))
    best_n = -F.col("best.col1")
    taken = best_n >= FACTOR * F.col("n")
    return words.join(per.hint("merge"), "word", "left").select(  # one row per word: never broadcast
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, best_n).alias("form_n"))


def with_roots(rows: DataFrame) -> DataFrame:
    """``rows`` with ``root``: forms followed to the last, twice as far in every round.

    n at least doubles with each form, so there are no cycles and few rounds.
    """
    links = stored(rows.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("to"))
        met = stored(join_on_hot_key(links, ahead, "root", "word"))
        links = met.select("word", F.coalesce("to", "root").alias("root"))
        if met.filter("to is not null").isEmpty():
            break
    return rows.join(links.hint("merge"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      group: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of the vocabulary.

    Null and empty texts have no words; a null id hashes as the empty text; repeated rows count;
    ties of n go to the first word in code-point order; an empty table gives no rows; texts and
    runs of any length are read whole; other columns do not matter.
    """
    words = vocabulary(docs, doc_id, text)
    rows = stored(forms(words, near_pairs(words, group)))
    return with_roots(rows).select("word", "form", "root", "n", "n_near", "form_n")


def oracle(documents: str = "documents") -> str:
    """The same in plain SQL: crc32 byte by byte, near words by equal holes and equal deletions."""
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    return f"""
with recursive crc_steps as (
  select i, 0 as k, i as c from range(256) t(i)
  union all
  select i, k + 1, case when c & 1 = 1 then xor(c >> 1, {0xEDB88320}) else c >> 1 end
  from crc_steps where k < 8),
crc_table as materialized (select list(c order by i) as tab from crc_steps where k = 8),
runs as materialized (
  select id, run, count(*) as k, hex(id || ':' || run) as code from (
    select coalesce(cast(doc_id as varchar), '') as id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), '{upper}', '{lower}'), '[a-zÀ-ÿ]+')) as run
    from {documents}) group by id, run),
hashed as materialized (
  select run, k, xor({0xFFFFFFFF}, list_reduce([{0xFFFFFFFF}] || list_transform(
      range(1, len(code), 2), lambda i: cast('0x' || substr(code, i, 2) as bigint)),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) as h
  from runs, crc_table),
words as materialized (
  select word, cast(sum(k) as bigint) as n from (
    select k, case when h % {TYPO} = 0 then substr(run, 1, h % length(run))
                                || substr(run, h % length(run) + 2) else run end as word from hashed)
  where length(word) >= {LEAST_LENGTH} group by word having sum(k) >= {LEAST_COUNT}),
holes as materialized (
  select word, i, substr(word, 1, i - 1) as a, substr(word, i + 1) as z
  from (select word, unnest(range(1, length(word) + 1)) as i from words)),
shorter as materialized (select distinct h.word, w.word as near from holes h join words w on w.word = a || z),
near as materialized (
  select x.word, y.word as near from holes x join holes y using (i, a, z) where x.word <> y.word
  union all select word, near from shorter
  union all select near, word from shorter),
forms as materialized (
  select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.best.n >= {FACTOR} * w.n then b.best.near end as form,
         case when b.best.n >= {FACTOR} * w.n then b.best.n end as form_n
  from words w left join (
    select r.word, count(*) as n_near, arg_min({{'near': r.near, 'n': m.n}}, (-m.n, r.near)) as best
    from near r join words m on m.word = r.near group by r.word) b using (word)),
roots as (
  select word, word as at from forms
  union all
  select r.word, f.form from roots r join forms f on f.word = r.at where f.form is not null)
select f.word, f.form, r.at as root, f.n, f.n_near, f.form_n
from forms f join roots r using (word) join forms e on e.word = r.at and e.form is null"""
