"""Secret scan with a random forest that removes false positives.

Candidates are long unbroken tokens. A forest scores each from its length, character transitions,
dictionary coverage, the path of its document and the words beside it, and is trained on labelled
findings.

Where no labelled findings are given, two independent views label for each other: the rule of one view
teaches a forest that sees only the other. Words and path around a candidate say whether it is assigned
like a secret; they label for the forest over its characters. The characters say whether it looks
drawn at random; they label for the forest over words and path. No forest sees an input of its own
labels, and a finding is kept only where both agree: a placeholder in quotes and a bare hash are
overturned, and a form that no rule names is found by what it shares with those that one does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.llm.pii import located
from lossloom.llm.storage import stored
from lossloom.llm.text import bucket, whole, words

# An equals sign belongs to a candidate as padding only; before a value it ends the name.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:={1,2}+(?![A-Za-z0-9+/_-]))?"
# Words that stand before assigned secrets, and parts of paths that hold made-up ones.
KEYWORD = r"(?i)(token|secret|passw|pwd|api.?key|access.?key|private|credential|auth)"
ASSIGNED = KEYWORD + r"[A-Za-z0-9_. -]{0,16}[\"']?\s*(=|:|:=|=>)\s*[\"']?$"
SAMPLE_PATH = r"(?i)(test|example|sample|fixture|mock|doc|readme|license|vendor)"
FEATURES = ["length", "digit_share", "upper_share", "symbol_share", "distinct_share",
            "transitions", "coverage", "hex", "path_sample", "path_depth", "keyword_before",
            "assigned", "quoted", "words_before", "word_after"]
CHARACTERS = ["length", "digit_share", "upper_share", "symbol_share", "distinct_share",
              "transitions", "coverage", "hex"]
SURROUNDINGS = [f for f in FEATURES if f not in CHARACTERS]
LETTERS = 26


@dataclass(frozen=True)
class Settings:
    """Bound of the training sample per class; the forest; least count of a dictionary word;
    folds of documents (fold 0 teaches nothing); probability from which a finding is kept."""
    max_findings: int = 10_000
    trees: int = 20
    depth: int = 6
    min_word_count: int = 5
    folds: int = 5
    at_least: float = 0.5
    seed: int = 42


DEFAULT = Settings()


def dictionary(docs: DataFrame, text: str = "text", settings: Settings = DEFAULT) -> bytes:
    """A byte per letter trigram: 1 if an ordinary word of the corpus holds it.

    Ordinary: 3 to 15 letters, counted ``min_word_count`` times over all texts. Words combine in the
    map tasks; at most 26 ** 3 trigrams reach the driver.
    """
    one = docs.select(F.explode(words(F.lower(whole(text)))).alias("w")).select(
        F.regexp_replace("w", "^[^a-z]+|[^a-z]+$", "").alias("w")).filter(
        F.col("w").rlike("^[a-z]{3,15}$"))
    common = one.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") >= settings.min_word_count)
    grams = common.select(F.explode(F.transform(
        F.sequence(F.lit(1), F.length("w") - 2), lambda i: F.substr("w", i, F.lit(3)))).alias("g"))
    table = bytearray(LETTERS ** 3)
    for r in grams.distinct().collect():
        a, b, c = (ord(x) - 97 for x in r["g"])
        table[(a * LETTERS + b) * LETTERS + c] = 1
    return bytes(table)


def candidates(docs: DataFrame, doc_id: str, text: str, path: str) -> DataFrame:
    """(doc_id, path, start, end, m, left, right) of all candidates of the whole texts."""
    return docs.select(F.col(doc_id).alias("doc_id"),
                       F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
                       whole(text).alias("t")).select(
        "doc_id", "path", located(F.col("t"), CANDIDATE, "[A-Za-z0-9+/_-]{16}").alias("found")).select(
        "doc_id", "path", F.explode(F.transform("found", with_name)).alias("c")
    ).select("doc_id", "path", "c.*")


def with_name(c: Column, i: Column) -> Column:
    """``left`` goes on into the candidate before, if that is near: it may be the name."""
    last = F.get("found", i - 1)
    near = last["end"] + F.length(c["left"]) == c["start"]
    return c.withField("left", F.when((i > 0) & near, F.substring(
        F.concat(last["m"], c["left"]), -48, 48)).otherwise(c["left"]))


def codes(m: Column) -> Column:
    """Letter numbers of the candidate's characters, lower-cased; others lie outside 0 to 25."""
    return F.transform(F.split(F.lower(m), ""), lambda x: F.ascii(x) - 97)


def coverage(code: Column, table: bytes) -> Column:
    """Share of the candidate's trigrams that ordinary words hold; others than letters count as
    not held. ``code`` must be a stored column: it is read three times a trigram."""
    known = F.unhex(F.lit(table.hex()))

    def held(i: Column) -> Column:
        a, b, c = F.get(code, i), F.get(code, i + 1), F.get(code, i + 2)
        good = a.between(0, 25) & b.between(0, 25) & c.between(0, 25)
        place = (a * LETTERS + b) * LETTERS + c + 1
        return good & (F.substr(known, place, F.lit(1)) == F.unhex(F.lit("01")))

    n = F.size(code) - 2
    return F.size(F.filter(F.sequence(F.lit(0), n - 1), held)) / n


def with_features(found: DataFrame, table: bytes) -> DataFrame:
    m, n = F.col("m"), F.length("m").cast("double")
    count = lambda rule: F.regexp_count(m, F.lit(rule)) / n
    change = (r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"
              r"|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])")
    return found.withColumn("__ll_code", codes(m)).withColumns({
        "length": F.least(n, F.lit(200.0)), "digit_share": count("[0-9]"),
        "upper_share": count("[A-Z]"), "symbol_share": count("[^A-Za-z0-9]"),
        "distinct_share": F.size(F.array_distinct(F.split(m, ""))) / n,
        "transitions": count(change), "coverage": coverage(F.col("__ll_code"), table),
        "hex": m.rlike("^[0-9a-fA-F]+$").cast("double"),
        "path_sample": F.col("path").rlike(SAMPLE_PATH).cast("double"),
        "path_depth": F.regexp_count("path", F.lit("/")).cast("double"),
        "keyword_before": F.col("left").rlike(KEYWORD).cast("double"),
        "assigned": F.col("left").rlike(ASSIGNED).cast("double"),
        "quoted": (F.col("left").rlike("[\"'`]$") & F.col("right").rlike("^[\"'`]")).cast("double"),
        "words_before": F.size(words(F.col("left"))).cast("double"),
        "word_after": F.col("right").rlike(r"^[.,;:!?]?\s*[A-Za-z]").cast("double")}
    ).drop("__ll_code")


def assigned_label() -> Column:
    """What the surroundings are sure of: 1 for a quoted token that is assigned to a keyword, 0 for one
    without a keyword before it, null for all others."""
    return F.when((F.col("assigned") == 1) & (F.col("quoted") == 1), 1).when(
        (F.col("assigned") == 0) & (F.col("keyword_before") == 0), 0)


def random_label() -> Column:
    """What the characters are sure of: 1 for letters and digits mixed with few trigrams of words, 0
    for a token of words, or of letters or digits alone; null for all others."""
    digits = F.col("digit_share")
    return F.when((digits >= 0.05) & (digits < 1) & (F.col("coverage") <= 0.25), 1).when(
        (digits == 1) | (F.col("coverage") >= 0.5) | ((digits == 0) & (F.col("symbol_share") == 0)), 0)


def train(findings: DataFrame, features: list[str] = FEATURES, settings: Settings = DEFAULT
          ) -> RandomForestClassificationModel | None:
    """Forest over ``features`` and ``label`` (0 or 1), at most ``max_findings`` rows a class, those of
    the smallest hashes. None if a class has no finding."""
    parts = [findings.filter(F.col("label") == k).orderBy(F.xxhash64("m", "left"), "m", "left")
             .limit(settings.max_findings) for k in (0, 1)]
    sample = stored(parts[0].unionByName(parts[1]).select("label", *features))
    if sample.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=features, outputCol="__ll_x").transform(sample)
    forest = RandomForestClassifier(
        featuresCol="__ll_x", labelCol="label", numTrees=settings.trees, maxDepth=settings.depth,
        seed=settings.seed, cacheNodeIds=False)
    return forest.fit(rows.withColumn("label", F.col("label").cast("double")))


def with_probability(found: DataFrame, forest: RandomForestClassificationModel | None,
                     features: list[str], out: str, rule: Column) -> DataFrame:
    """``found`` with the forest's probability; without a forest that of the rule (unsure: 0)."""
    if forest is None:
        return found.withColumn(out, F.coalesce(rule, F.lit(0)).cast("double"))
    rows = VectorAssembler(inputCols=features, outputCol="__ll_x").transform(found)
    return forest.transform(rows).select(
        *found.columns, F.get(vector_to_array("probability"), F.lit(1)).alias(out))


def by_views(found: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """``found`` with by_characters and by_surroundings, each learned from the rule of the other view
    over documents outside fold 0, and probability, their product: that both are right."""
    learn = found.filter(bucket("doc_id", settings.folds) != 0)
    views = (("by_characters", CHARACTERS, assigned_label(), random_label()),
             ("by_surroundings", SURROUNDINGS, random_label(), assigned_label()))
    for name, features, teacher, own in views:
        labelled = learn.withColumn("label", teacher).filter("label is not null")
        found = with_probability(found, train(labelled, features, settings), features, name, own)
    return found.withColumn("probability", F.col("by_characters") * F.col("by_surroundings"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source",
         labelled: DataFrame | None = None, settings: Settings = DEFAULT) -> DataFrame:
    """doc_id, start, end, sha256, probability, is_secret: a row per candidate, the strings hashed.

    ``labelled`` (FEATURES, m, left, label) are findings to learn from; without it the two views teach
    each other. A view whose teacher knows one class only falls back on its own rule (unsure:
    0); so does ``labelled`` with one class, on both rules. Null texts have no candidates; null paths
    are empty; repeated rows are reported each; an empty table gives no rows.
    """
    found = stored(with_features(candidates(docs, doc_id, text, path),
                                 dictionary(docs, text, settings)).drop("path", "right"))
    if labelled is None:
        scored = by_views(found, settings)
    else:
        scored = with_probability(found, train(labelled, FEATURES, settings), FEATURES, "probability",
                                  assigned_label() * random_label())
    return scored.select(F.col("doc_id").alias(doc_id), "start", "end",
                         F.sha2("m", 256).alias("sha256"), "probability",
                         (F.col("probability") >= settings.at_least).alias("is_secret"))
