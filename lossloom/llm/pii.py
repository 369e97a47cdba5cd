"""Personal data: base spans by pattern, more by bootstrapped contexts.

Base spans (e-mail, IP, card, phone) are exact. Their strings are the seeds of a graph between
lexical patterns (the word before or after an identifier, with the identifier's shape) and
instances (identifier strings). Spark scores both sides in turn: a pattern is trusted for a kind
if most of its distinct instances are known ones of that kind and its word hardly occurs without
an identifier; an instance is trusted if its patterns are. Identifiers that no base rule knows
are reported where a trusted pattern meets a trusted instance.

Everything is column expressions, aggregates and joins; texts never leave the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.llm.storage import is_small, join_on_hot_key, stored
from lossloom.llm.text import whole, words

KINDS = ("email", "ip", "card", "phone")

# The rules, written so that a failed try costs no second look at the same characters: runs are
# possessive and start where a run starts (or where the last match ended).
_LOCAL = "A-Za-z0-9._%+-"
RULES = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without this holds no span of the kind.
NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){12}",
          "phone": r"\+[0-9]"}
#: Tokens that may be identifiers: at least six characters with a digit, or an address sign.
TOKEN = (r"(?<![A-Za-z0-9_.@/-])(?=[A-Za-z_./-]*+[0-9@])[A-Za-z0-9_]"
         r"[A-Za-z0-9_.@/-]{4,}[A-Za-z0-9_]")
OCCURRENCE = "|".join([*(f"(?:{RULES[k]})" for k in ("email", "phone", "card", "ip")), TOKEN])
SPAN = "array<struct<kind:string,start:int,end:int>>"


@dataclass(frozen=True)
class Bootstrap:
    """Rounds of scoring, and when a pattern or an instance counts as trusted."""
    rounds: int = 2
    min_seeds: int = 3
    pattern_confidence: float = 0.6
    instance_confidence: float = 0.6
    specific: float = 0.2


DEFAULT = Bootstrap()


def located(text: Column, rule: str, needed: str) -> Column:
    """array<struct<m, start, end, left, right>> of the non-overlapping matches of ``rule``.

    Offsets are code points. They come from the lengths of the matches and of the pieces between
    them; ``left`` and ``right`` are the neighbouring pieces' ends.
    """
    found = F.regexp_extract_all(text, F.lit(rule), F.lit(0))
    pieces = F.split(text, rule, -1)
    empty = F.array().cast("array<struct<m:string,start:int,end:int,left:string,right:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["piece"])
        end = begin + F.length(x["m"])
        return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct(
            x["m"].alias("m"), begin.alias("start"), end.alias("end"),
            F.substring(x["piece"], -48, 48).alias("left"),
            F.substring(x["after"], 1, 48).alias("right"))).alias("out"))

    zipped = F.transform(found, lambda m, i: F.struct(m.alias("m"), i.alias("i")))
    both = F.arrays_zip(zipped.alias("z"), pieces.alias("piece"),
                        F.slice(pieces, 2, F.greatest(F.size(found), F.lit(1))).alias("after"))
    rows = F.transform(F.filter(both, lambda x: x["z"].isNotNull()), lambda x: F.struct(
        x["z"]["m"].alias("m"), x["piece"].alias("piece"), x["after"].alias("after")))
    return F.when(text.rlike(needed), F.aggregate(rows, start, step, lambda a: a["out"])).otherwise(
        empty)


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    d = digits(m)
    n = F.length(d)

    def add(total: Column, i: Column) -> Column:
        x = F.ascii(F.substr(d, n - i, F.lit(1))) - 48
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return total + F.when(i % 2 == 1, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def passes(kind: str, m: Column) -> Column:
    """Whether a match of the kind's rule is a span of the kind."""
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(m, "[.]", -1), lambda p: (F.length(part(p)) <= 3) & (
            F.lpad(part(p), 3, "0") <= "255"))
    if kind == "card":
        return F.length(digits(m)).between(13, 19) & luhn(m)
    if kind == "phone":
        return F.length(digits(m)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All base spans, by kind as listed, then start."""
    def of(kind: str) -> Column:
        good = F.filter(located(text, RULES[kind], NEEDED[kind]), lambda x: passes(kind, x["m"]))
        return F.transform(good, lambda x: F.struct(
            F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    return F.concat(*map(of, KINDS)).cast(SPAN)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"], x["end"])), ",")


def shape(m: Column) -> Column:
    return F.when(m.contains("@"), "address").when(m.rlike(r"^[0-9+(][0-9 ().-]*$"), "number"
                                                   ).otherwise("mixed")


def occurrences(text: Column) -> Column:
    """Base spans and other identifier-like tokens with the words beside them."""
    def kind(m: Column) -> Column:
        at = F.when(m.rlike(f"^{RULES['email']}$"), "email")
        for k in ("phone", "card", "ip"):
            at = at.when(m.rlike(f"^(?:{RULES[k]})$") & passes(k, m), k)
        return at

    def word(piece: Column, last: bool) -> Column:
        w = words(piece)
        return F.lower(F.coalesce(F.try_element_at(w, F.lit(-1)) if last else F.get(w, F.lit(0)), F.lit("")))

    return F.transform(located(text, OCCURRENCE, "[0-9@]"), lambda x: F.struct(
        kind(x["m"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
        F.lower(x["m"]).alias("instance"), shape(x["m"]).alias("shape"),
        F.array(F.concat(F.lit("after "), word(x["left"], True)),
                F.concat(F.lit("before "), word(x["right"], False))).alias("contexts")))


def features(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, text hash, base spans and occurrences per row: stored once, without the texts."""
    body = whole(text)
    one = docs.select(F.col(doc_id).alias("id"), body.alias("body"))
    return stored(one.select("id", F.xxhash64("body").alias("hash"), F.length("body").alias("len"),
                             base_spans(F.col("body")).alias("base"),
                             occurrences(F.col("body")).alias("seen")))


def word_counts(docs: DataFrame, text: str, contexts: DataFrame) -> DataFrame:
    """(word, n): how often the words of ``contexts`` stand anywhere in the whole texts.

    Words count in the map tasks before anything is shuffled; the list of context words is
    broadcast if it is measured small, else joined to the counts.
    """
    every = docs.select(F.explode(words(F.lower(whole(text)))).alias("word"))
    if is_small(contexts, "word"):
        return every.join(F.broadcast(contexts), "word", "left_semi").groupBy("word").agg(
            F.count(F.lit(1)).alias("n"))
    return every.groupBy("word").agg(F.count(F.lit(1)).alias("n")).join(contexts, "word", "left_semi")


def learn(docs: DataFrame, seen: DataFrame, text: str, options: Bootstrap = DEFAULT):
    """Trusted patterns (pattern, kind, confidence) and instances (instance, kind, confidence).

    ``seen`` is the exploded occurrences. Patterns whose word mostly stands without an identifier
    leave before the graph is built, which also removes the hot ones of common words.
    """
    edges = seen.select("kind", "instance", F.explode("contexts").alias("context"), "shape")
    backed = edges.filter("kind is not null").groupBy("context", "shape").agg(
        F.countDistinct("instance").alias("seeds")).filter(F.col("seeds") >= options.min_seeds)
    word = F.substring_index("context", " ", -1)
    backed = stored(backed.withColumn("word", word).filter("word <> ''"))
    if backed.isEmpty():
        return None
    counts = word_counts(docs, text, backed.select("word").distinct())
    used = edges.select("context", "shape").join(
        F.broadcast(backed) if is_small(backed, "context", "word") else backed,
        ["context", "shape"], "left_semi")
    stands = used.groupBy("context", "shape").agg(F.count(F.lit(1)).alias("stands"))
    specific = stored(stands.withColumn("word", word).join(counts, "word").select(
        F.concat_ws(" ", "shape", "context").alias("pattern"),
        F.least(F.lit(1.0), F.col("stands") / F.col("n")).alias("specific"))
        .filter(F.col("specific") >= options.specific))
    pair = edges.select(F.concat_ws(" ", "shape", "context").alias("pattern"), "instance", "kind")
    graph = stored(join_on_hot_key(pair, specific, "pattern", "instance", "inner").groupBy(
        "pattern", "instance").agg(F.max("kind").alias("kind"), F.max("specific").alias("specific")))
    known = graph.filter("kind is not null").select("instance", "kind").distinct().withColumn(
        "confidence", F.lit(1.0))
    patterns = None
    for _ in range(options.rounds):
        patterns = stored(score_patterns(graph, known, options))
        known = stored(score_instances(graph, patterns, options))
    return patterns, known


def score_patterns(graph: DataFrame, known: DataFrame, options: Bootstrap) -> DataFrame:
    """Confidence per pattern and kind: trusted share of its distinct instances, damped by one
    unseen instance, times how specific its word is."""
    per = known.groupBy("instance").agg(F.max(F.struct("confidence", "kind")).alias("k"))
    voted = graph.select("pattern", "instance", "specific").join(per, "instance", "left")
    totals = voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("all"),
                                          F.max("specific").alias("specific"))
    votes = voted.filter("k is not null").groupBy("pattern", F.col("k.kind").alias("kind")).agg(
        F.sum("k.confidence").alias("trust"))
    best = votes.groupBy("pattern").agg(F.max(F.struct("trust", "kind")).alias("b"))
    return totals.join(best, "pattern").select(
        "pattern", F.col("b.kind").alias("kind"),
        (F.col("b.trust") / (F.col("all") + 1) * F.col("specific")).alias("confidence")).filter(
        F.col("confidence") >= options.pattern_confidence / 2)


def score_instances(graph: DataFrame, patterns: DataFrame, options: Bootstrap) -> DataFrame:
    """Seeds keep confidence 1; others: one minus the chance that all their patterns err."""
    seeds = graph.filter("kind is not null").select(
        "instance", "kind", F.lit(1.0).alias("confidence")).distinct()
    open_ = join_on_hot_key(graph.filter("kind is null").select("pattern", "instance"), patterns,
                            "pattern", "instance", "inner")
    found = open_.groupBy("instance", "kind").agg(
        (1 - F.exp(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999)))))).alias("confidence"))
    return seeds.unionByName(found.filter(F.col("confidence") >= options.instance_confidence))


def discovered(docs: DataFrame, rows: DataFrame, text: str,
               options: Bootstrap = DEFAULT) -> DataFrame | None:
    """(id, hash, len, more): spans that the contexts add, one row per text; None if there are
    no patterns."""
    seen = rows.filter(F.size("seen") > 0).select("id", "hash", "len", F.explode("seen").alias("o"))
    seen = seen.select("id", "hash", "len", "o.*")
    model = learn(docs, seen, text, options)
    if model is None:
        return None
    patterns, known = model
    trusted = patterns.filter(F.col("confidence") >= options.pattern_confidence).select("pattern", "kind")
    open_ = seen.filter("kind is null").drop("kind").withColumn(
        "pattern", F.explode("contexts")).withColumn(
        "pattern", F.concat_ws(" ", "shape", "pattern")).drop("contexts", "shape")
    matched = join_on_hot_key(open_, trusted, "pattern", "instance", "inner")
    sure = known.select("instance", "kind").distinct()
    hits = matched.join(F.broadcast(sure) if is_small(sure, "instance") else sure,
                        ["instance", "kind"], "left_semi")
    return stored(hits.groupBy("id", "hash", "len").agg(
        F.collect_set(F.struct("kind", "start", "end")).cast(SPAN).alias("more")))


def with_spans(rows: DataFrame, more: DataFrame | None, key: tuple[str, str, str],
               base: str) -> DataFrame:
    """Add ``__ll_spans``: base and discovered spans by kind as listed, then start."""
    if more is None:
        return rows.withColumn("__ll_spans", F.col(base))
    found = more.select(F.col("id").alias("__ll_i"), F.col("hash").alias("__ll_h"),
                        F.col("len").alias("__ll_n"), F.col("more").alias("__ll_more"))
    if is_small(found):
        found = F.broadcast(found)
    on = (rows[key[0]].eqNullSafe(found["__ll_i"]) & (rows[key[1]] == found["__ll_h"])
          & (rows[key[2]] == found["__ll_n"]))
    every = F.concat(F.col(base), F.coalesce("__ll_more", F.array().cast(SPAN)))
    rank = lambda x: F.array_position(F.array(*map(F.lit, KINDS)), x["kind"])
    ordered = F.array_sort(F.transform(every, lambda x: F.struct(
        rank(x).alias("r"), x["start"].alias("start"), x["end"].alias("end"),
        x["kind"].alias("kind"))))
    return rows.join(found, on, "left").withColumn("__ll_spans", F.transform(
        ordered, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"),
                                    x["end"].alias("end"))).cast(SPAN)).drop(
        "__ll_i", "__ll_h", "__ll_n", "__ll_more")


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             options: Bootstrap = DEFAULT) -> DataFrame:
    """doc_id, spans (array of kind, start, end: base and discovered), base spans: a row per row.

    Offsets are code points with exclusive ends. Null and empty texts have no spans; rows without
    an id and repeated rows get theirs; an empty table gives no rows.
    """
    rows = features(docs, doc_id, text)
    out = with_spans(rows, discovered(docs, rows, text, options), ("id", "hash", "len"), "base")
    return out.select(F.col("id").alias(doc_id), F.col("__ll_spans").alias("spans"), "base")


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts of base spans per kind, the hash of the base spans and all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return found.select(doc_id, *(count(k).alias(f"n_{k}") for k in KINDS),
                        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans by the first."""
    by_start = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))

    def step(acc: Column, x: Column) -> Column:
        fresh = x["start"] >= acc["at"]
        between = F.substr(text, acc["at"] + 1, x["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], between, F.lit("["), F.upper(x["kind"]), F.lit("]")))
            .otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        by_start, start, step,
        lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1, F.length(text)))))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           options: Bootstrap = DEFAULT) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; null texts stay null, all rows stay."""
    more = discovered(docs, features(docs, doc_id, text), text, options)
    body = whole(text)
    rows = docs.withColumns({"__ll_hash": F.xxhash64(body), "__ll_len": F.length(body),
                             "__ll_base": base_spans(body)})
    out = with_spans(rows, more, (doc_id, "__ll_hash", "__ll_len"), "__ll_base")
    return out.withColumn(text, F.when(F.col(text).isNotNull(), redacted(body, F.col("__ll_spans")))
                          ).select(*docs.columns)
