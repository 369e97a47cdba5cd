"""Quality rules per document, judged with the record of the document's host.

A document fails when a measured value passes a rule's limit. Failures are counted per host, the
rates are shrunk towards a beta prior fitted to all hosts, and each host gets a verdict that sets
how strictly its documents are read: a suspect host narrows every limit, a trusted one widens
them. A document that meets the narrow limits stays, wherever it comes from.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.llm.storage import join_on_hot_key, stored
from lossloom.llm.text import NOT_SPACE, n_of, whole, words

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; hosts scale the soft ones by ``suspect_scale`` or ``trusted_scale``."""
    min_words: int = 10
    max_repeat_percent: int = 20
    symbols_per_word: float = 0.1
    dup_line_share: float = 0.3
    marks_per_word: float = 0.5
    mean_word_chars: float = 15.0
    suspect_rate: float = 0.4
    trusted_rate: float = 0.01
    suspect_scale: float = 0.75
    trusted_scale: float = 1.5


DEFAULT = Rules()
DIGEST = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``__ll_m``: the measures of each whole text (null text: as empty, all zero).

    The windows found twice come from their sorted hashes in the row itself: no shuffle, and
    n log n for a text of any length. Texts without a repeated window skip the sort.
    """
    body = F.col("__ll_t")
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(NOT_SPACE))
    w = F.col("__ll_w")
    one = docs.withColumn("__ll_t", whole(text)).withColumns({
        "__ll_w": words(body), "__ll_l": lines})
    two = one.withColumns({
        "__ll_c": F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            n_of(body, SYMBOLS).alias("n_symbols"),
            (F.size("__ll_l") - F.size(F.array_distinct("__ll_l"))).cast("long")
            .alias("n_dup_lines"),
            F.size("__ll_l").cast("long").alias("n_lines"),
            n_of(body, "[!]").alias("n_marks")),
        "__ll_h": F.when(F.size(w) >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w) - WINDOW, F.lit(0))),
            lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW)))))
        .otherwise(F.array().cast("array<bigint>"))}).drop("__ll_t", "__ll_w", "__ll_l")
    h, s, p = F.col("__ll_h"), F.col("__ll_s"), F.col("__ll_p")
    pairs = F.transform(h, lambda v, i: F.struct(v.alias("v"), i.alias("i")))
    three = two.withColumn("__ll_s", F.when(
        F.size(F.array_distinct(h)) < F.size(h), F.sort_array(pairs))
        .otherwise(F.array().cast("array<struct<v:bigint,i:int>>"))).drop("__ll_h")

    def twin(x: Column, k: Column) -> Column:
        before = (k > 0) & (F.get(s, k - 1)["v"] == x["v"])
        return before | (F.get(s, k + 1)["v"] == x["v"])

    four = three.withColumn("__ll_p", F.sort_array(F.transform(
        F.filter(s, lambda x, k: F.coalesce(twin(x, k), F.lit(False))), lambda x: x["i"])))
    covered = F.transform(p, lambda x, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
    repeated = F.aggregate(covered.cast("array<bigint>"), F.lit(0).cast("long"),
                           lambda a, x: a + x)
    return four.withColumn("__ll_m", F.col("__ll_c").withField("n_repeat_words", repeated)).drop(
        "__ll_s", "__ll_p", "__ll_c")


def base_failed(m: Column, rules: Rules = DEFAULT) -> Column:
    return (m["n_words"] < rules.min_words) | (
        100 * m["n_repeat_words"] > rules.max_repeat_percent * m["n_words"])


def excess(m: Column, rules: Rules = DEFAULT) -> Column:
    """Largest measured value in units of its limit; 1 and below meets every soft rule."""
    per_word = F.greatest(m["n_words"], F.lit(1)).cast("double")
    return F.greatest(
        m["n_symbols"] / per_word / rules.symbols_per_word,
        m["n_marks"] / per_word / rules.marks_per_word,
        m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1)).cast("double")
        / rules.dup_line_share,
        m["word_chars"] / per_word / rules.mean_word_chars)


def host_key(host: str = "source") -> Column:
    """The host as a key that is never null: no host is a host of its own."""
    return F.when(F.col(host).isNull(), F.lit("none")).otherwise(
        F.concat(F.lit("host "), F.col(host).cast("string")))


def host_verdicts(judged: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Per ``__ll_host``: documents, failures, shrunk rate and the scale of the soft limits.

    ``judged`` has ``__ll_host`` and boolean ``__ll_failed``. The counts combine before the
    shuffle. The prior's mean is the overall rate and its strength comes from the spread of the
    host rates beyond binomial noise (moments); five sums over the hosts reach the driver.
    """
    hosts = stored(judged.groupBy("__ll_host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("__ll_failed").cast("long")).alias("f")))
    n, f = F.col("n").cast("double"), F.col("f").cast("double")
    row = hosts.agg(F.count(F.lit(1)).alias("h"), F.sum("n").alias("n"), F.sum("f").alias("f"),
                    F.sum(n * n).alias("nn"), F.sum(f * f / n).alias("ff")).first()
    a, b = beta_prior(row["h"], row["n"] or 0, row["f"] or 0, row["nn"] or 0.0, row["ff"] or 0.0)
    rate = (f + a) / (n + a + b)
    return hosts.select("__ll_host", F.col("n").alias("host_docs"), F.col("f").alias("host_failed"),
                        rate.alias("host_rate"),
                        F.when(rate > rules.suspect_rate, rules.suspect_scale)
                        .when(rate < rules.trusted_rate, rules.trusted_scale)
                        .otherwise(1.0).alias("host_scale"))


def beta_prior(hosts: int, n: float, f: float, nn: float, ff: float) -> tuple[float, float]:
    """Beta parameters from the moments of the host rates.

    nn: sum of n * n; ff: sum of f * f / n over the hosts.
    """
    if n <= 0:
        return 1.0, 1.0
    p = min(max(f / n, 1e-6), 1 - 1e-6)
    noise = p * (1 - p)
    free = n - nn / n - (hosts - 1)
    rho = (ff - n * p * p - noise * (hosts - 1)) / (noise * free) if free > 0 else 0.01
    strength = 1 / min(max(rho, 1e-4), 0.9) - 1
    return p * strength, (1 - p) * strength


def judge(docs: DataFrame, rules: Rules = DEFAULT, doc_id: str = "doc_id", text: str = "text",
          host: str = "source") -> DataFrame:
    """Measures, base verdict, host verdict and decision: one row per row of ``docs``.

    Null texts count as empty (fail: too few words), documents without a host share one host of
    their own, repeated rows are judged each, an empty table gives no rows. Texts are scanned
    once; only the digest is stored and joined.
    """
    m = F.col("__ll_m")
    rows = with_measures(docs.select(doc_id, host, text), text).select(
        F.col(doc_id).alias("__ll_id"), host_key(host).alias("__ll_host"), "__ll_m",
        base_failed(m, rules).alias("__ll_base"), excess(m, rules).alias("__ll_excess"))
    digest = stored(rows.withColumn(
        "__ll_failed", F.col("__ll_base") | (F.col("__ll_excess") > 1)))
    verdicts = host_verdicts(digest, rules)
    joined = join_on_hot_key(digest, verdicts, "__ll_host", "__ll_id")
    return joined.select(
        F.col("__ll_id").alias(doc_id), *(m[c].alias(c) for c in DIGEST),
        F.col("__ll_base").alias("base_failed"),
        (~F.col("__ll_base") & (F.col("__ll_excess") <= F.col("host_scale"))).alias("kept"),
        F.col("__ll_excess").alias("excess"), "host_rate", "host_scale")


def keep_good(docs: DataFrame, rules: Rules = DEFAULT, text: str = "text",
              host: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns.

    The texts are measured twice instead of being stored or joined by id: the second pass meets
    only the host verdicts, so repeated and null ids need no care.
    """
    m = F.col("__ll_m")

    def judged(df: DataFrame) -> DataFrame:
        return with_measures(df, text).withColumns({
            "__ll_host": host_key(host), "__ll_base": base_failed(m, rules),
            "__ll_excess": excess(m, rules)}).drop("__ll_m")

    first = judged(docs.select(host, text)).withColumn(
        "__ll_failed", F.col("__ll_base") | (F.col("__ll_excess") > 1))
    verdicts = host_verdicts(first, rules).select("__ll_host", "host_scale").withColumnRenamed(
        "host_scale", "__ll_scale")
    rest = join_on_hot_key(judged(docs), verdicts, "__ll_host", text)
    # One condition over both sides: parts of it must not sink below the measures, where Catalyst
    # would repeat their whole expressions.
    keep = F.when(F.col("__ll_base"), F.lit(False)).otherwise(
        F.col("__ll_excess") <= F.col("__ll_scale"))
    return rest.filter(keep).select(*docs.columns)


def oracle(rules: Rules = DEFAULT, documents: str = "documents") -> str:
    """``judge`` in plain SQL, host_rate rounded to 9 digits: windows are counted as texts, the prior comes
    from the same moments."""
    def real(x: float) -> str:
        return f"cast({x!r} as double)"

    word = "cast(greatest(n_words, 1) as double)"
    return f"""
with docs as materialized (
  select row_number() over () as r, doc_id, coalesce(text, '') as t,
         case when source is null then 'none' else 'host ' || source end as host from {documents}),
parts as materialized (
  select r, doc_id, host, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l
  from docs),
windows as materialized (
  select r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') as v
  from (select r, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from parts where len(w) >= {WINDOW})),
repeats as (
  select r, count(distinct k) as n from (
    select r, unnest(range(i, i + {WINDOW})) as k from windows
    where (r, v) in (select (r, v) from windows group by r, v having count(*) > 1)) group by r),
measured as (
  select p.r, doc_id, host, cast(len(w) as bigint) as n_words,
         cast(length(array_to_string(w, '')) as bigint) as word_chars,
         cast(len(regexp_extract_all(t, '{SYMBOLS}')) as bigint) as n_symbols,
         cast(len(regexp_extract_all(t, '!')) as bigint) as n_marks,
         cast(len(l) as bigint) as n_lines, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
         coalesce(n, 0) as n_repeat_words
  from parts p left join repeats using (r)),
judged as materialized (
  select *, n_words < {rules.min_words}
         or 100 * n_repeat_words > {rules.max_repeat_percent} * n_words as base_failed,
         greatest(n_symbols / {word} / {real(rules.symbols_per_word)},
                  n_marks / {word} / {real(rules.marks_per_word)},
                  n_dup_lines / cast(greatest(n_lines, 1) as double) / {real(rules.dup_line_share)},
                  word_chars / {word} / {real(rules.mean_word_chars)}) as excess from measured),
hosts as materialized (
  select host, cast(count(*) as double) as n,
         cast(count(case when base_failed or excess > 1 then 1 end) as double) as f
  from judged group by host),
sums as (select count(*) as h, sum(n) as n, sum(n * n) as nn, sum(f * f / n) as ff,
                least(greatest(sum(f) / sum(n), 1e-6), 1 - 1e-6) as p from hosts),
spread as (select *, p * (1 - p) as noise, n - nn / n - (h - 1) as free from sums),
prior as (
  select p, 1 / least(greatest(case when free > 0 then (ff - n * p * p - noise * (h - 1))
         / (noise * free) else 0.01 end, 1e-4), 0.9) - 1 as strength from spread),
rated as (
  select host, (f + p * strength) / (n + p * strength + (1 - p) * strength) as rate from hosts, prior),
scaled as (
  select *, case when rate > {rules.suspect_rate} then {real(rules.suspect_scale)}
         when rate < {rules.trusted_rate} then {real(rules.trusted_scale)} else 1e0 end as host_scale from rated)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and excess <= host_scale as kept, excess, round(rate, 9) as host_rate, host_scale
from judged join scaled using (host)"""
