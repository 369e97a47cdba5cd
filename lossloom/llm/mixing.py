"""Mix sources to target weights by temperature.

Weights are token shares raised to an exponent between 1 (the natural mix) and 0 (all sources
alike). The smallest exponent is bisected at which the entropy of the weights stays within its
target and no source is repeated more often than allowed. Each source then gets its share of the
token budget as whole permutations of its documents (epochs) and one last permutation, cut where
the budget ends. A permutation deals n documents to about the root of n blocks by hash and orders each
block by hash: prefix sums run over blocks, only the block of the cut is ordered, and neither has more
than about the root of n rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lossloom.llm.storage import join_on_hot_key, stored
from lossloom.llm.text import whole, words


@dataclass(frozen=True)
class Mix:
    """Targets: entropy as a share of the largest possible, repeats of a source, token budget
    (None: all tokens there are); seed of the permutations."""
    entropy: float = 0.95
    max_repeats: float = 4.0
    tokens: int | None = None
    seed: int = 42


DEFAULT = Mix()
#: Halvings of the exponent's interval: HALVINGS a job, ROUNDS jobs.
HALVINGS, ROUNDS = 6, 5


def n_tokens(text: Column) -> Column:
    return F.size(words(whole(text))).cast("long")


def source_key(source: str) -> Column:
    """Source as a text key that is never null: no source is one of its own."""
    return F.when(F.col(source).isNull(), F.lit("none")).otherwise(
        F.concat(F.lit("source "), F.col(source).cast("string")))


def exponent(sources: DataFrame, n: int, total: int, budget: float, mix: Mix) -> float:
    """Smallest exponent in [0, 1] that keeps both targets (1 if none does).

    Every job weighs all sources at the ends of 2^HALVINGS parts of the interval; only one row
    per exponent leaves it, whatever the number of sources.
    """
    low, high = 0.0, 1.0
    p = F.col("tokens") / F.lit(float(total))
    for step in range(ROUNDS):
        parts = 1 << HALVINGS
        width = (high - low) / parts
        points = [low + k * width for k in range(0 if step == 0 else 1, parts)]
        a = F.col("a")
        tried = sources.withColumn("a", F.explode(F.array(*map(F.lit, points)))).groupBy("a").agg(
            F.sum(F.pow(p, a)).alias("z"), F.sum(F.pow(p, a) * F.log(p)).alias("zl"),
            F.max(F.pow(p, a - 1)).alias("top"))
        fits = tried.filter((F.log("z") - a * F.col("zl") / F.col("z")
                             <= mix.entropy * log(n) + 1e-12)
                            & (F.lit(budget / total) * F.col("top") / F.col("z")
                               <= mix.max_repeats + 1e-12))
        best = fits.agg(F.min("a")).first()[0]
        if best is not None:
            if best <= low:
                return best
            high = best
        low = high - width
    return high


def plan(rows: DataFrame, mix: Mix = DEFAULT) -> DataFrame:
    """Per source ``__ll_source``: weight, target tokens, whole epochs and the cut of the last.

    ``rows`` has __ll_source, __ll_tokens and __ll_id (id and text hash as text). The counts combine
    before they are shuffled; the cut needs the token sums of blocks, then the documents of one
    block per source.
    """
    sources = stored(rows.groupBy("__ll_source").agg(
        F.sum("__ll_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")))
    some = sources.filter("tokens > 0")
    row = some.agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t")).first()
    total = row["t"] or 0
    budget = total if mix.tokens is None else mix.tokens
    a = exponent(some, row["n"], total, float(budget), mix) if total else 1.0
    p = F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(a))
    z = some.agg(F.sum(p)).first()[0] or 1.0
    target = F.round(p / z * F.lit(float(budget))).cast("long")
    goal = stored(some.select(
        "__ll_source", "tokens", "docs", (p / z).alias("weight"), target.alias("target"),
        F.floor(target / F.col("tokens")).cast("int").alias("epochs"),
        (target % F.col("tokens")).alias("rest"),
        F.ceil(F.sqrt(F.col("docs").cast("double"))).cast("long").alias("blocks")))
    drawn = join_on_hot_key(rows, goal.select("__ll_source", "epochs", "rest", "blocks"),
                            "__ll_source", "__ll_id", "inner").withColumns(
        {"place": place(F.col("epochs"), mix)}).withColumn("block", block(F.col("place"),
                                                                         F.col("blocks")))
    sums = drawn.groupBy("__ll_source", "block", "rest").agg(F.sum("__ll_tokens").alias("t"))
    order = Window.partitionBy("__ll_source").orderBy("block")
    before = F.sum("t").over(order) - F.col("t")
    cut = stored(sums.withColumn("before", before).filter(
        (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("t")))
        .select("__ll_source", F.col("block").alias("cut_block"),
                (F.col("rest") - F.col("before")).alias("left")))
    inside = join_on_hot_key(drawn, cut, "__ll_source", "__ll_id", "inner").filter(
        F.col("block") == F.col("cut_block"))
    running = F.sum("__ll_tokens").over(Window.partitionBy("__ll_source").orderBy("place"))
    last = inside.withColumn("sum", running).filter(F.col("sum") <= F.col("left")).groupBy(
        "__ll_source").agg(F.max("place").alias("cut_place"))
    return stored(goal.join(cut.drop("left"), "__ll_source", "left").join(last, "__ll_source", "left"))


def place(epoch: Column, mix: Mix) -> Column:
    """Place of a document in the permutation of an epoch: 64 hex digits."""
    return F.concat(F.md5(F.concat_ws("|", F.lit(mix.seed), epoch, F.substring_index(
        "__ll_id", "|", 1))), F.substring_index("__ll_id", "|", -1))


def block(place_: Column, blocks: Column) -> Column:
    return F.pmod(F.conv(F.substring(place_, 1, 12), 16, 10).cast("long"), blocks)


def marked(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit("none"))
    return docs.withColumns({
        "__ll_source": source_key(source), "__ll_tokens": n_tokens(F.col(text)),
        "__ll_id": F.concat_ws("|", F.regexp_replace(name, "[|]", "/"), F.md5(whole(text)))})


def draw(docs: DataFrame, mix: Mix = DEFAULT, doc_id: str = "doc_id", text: str = "text",
         source: str = "source") -> DataFrame:
    """``docs`` with ``epoch``, ``block`` and ``n_tokens``: a row per draw, in no order.

    Columns of ``docs`` with one of these names are replaced; all others pass through.

    Read by epoch, block and hash, the rows are the permutations. A document comes once per whole
    epoch of its source, and once more if it stands before the cut of the last. A source with no
    tokens has no weight and is not drawn; rows without a source form one source; rows alike in id
    and text are drawn together; null texts have no tokens. No budget is exceeded, an empty table
    gives no rows. Texts are read twice and are not shuffled while the sources stay a small table.
    """
    rows = marked(docs, doc_id, text, source)
    made = plan(stored(rows.select("__ll_source", "__ll_tokens", "__ll_id")), mix)
    per = made.select("__ll_source", *(F.col(c).alias(f"__ll_{c}") for c in (
        "epochs", "blocks", "cut_block", "cut_place")))
    out = join_on_hot_key(rows, per, "__ll_source", "__ll_id", "inner")
    at = place(F.col("__ll_epoch"), mix)
    here = block(at, F.col("__ll_blocks"))
    taken = (F.col("__ll_epoch") < F.col("__ll_epochs")) | (here < F.col("__ll_cut_block")) | (
        (here == F.col("__ll_cut_block")) & (at <= F.col("__ll_cut_place")))
    spread = out.withColumn("__ll_epoch", F.explode(F.sequence(F.lit(0), F.col("__ll_epochs"))))
    keep = [c for c in docs.columns if c not in ("epoch", "block", "n_tokens")]
    return spread.filter(F.coalesce(taken, F.lit(False))).select(
        *keep, F.col("__ll_epoch").alias("epoch"), here.alias("block"),
        F.col("__ll_tokens").alias("n_tokens"))


def mixed(docs: DataFrame, mix: Mix = DEFAULT, doc_id: str = "doc_id", text: str = "text",
          source: str = "source") -> DataFrame:
    """The draws without their texts, from a digest that is written once."""
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                              n_tokens(F.col(text)).alias("n"), F.md5(whole(text)).alias("m")))
    marks = rows.select("doc_id", "source", source_key("source").alias("__ll_source"),
                        F.col("n").alias("__ll_tokens"),
                        F.concat_ws("|", F.regexp_replace(F.coalesce(
                            F.col("doc_id").cast("string"), F.lit("none")), "[|]", "/"),
                            "m").alias("__ll_id"))
    made = plan(marks, mix).select("__ll_source", "epochs", "blocks", "cut_block", "cut_place")
    out = join_on_hot_key(marks, made, "__ll_source", "__ll_id", "inner").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.col("epochs"))))
    at = place(F.col("epoch"), mix)
    out = out.withColumn("place", at).withColumn("block", block(F.col("place"), F.col("blocks")))
    taken = (F.col("epoch") < F.col("epochs")) | (F.col("block") < F.col("cut_block")) | (
        (F.col("block") == F.col("cut_block")) & (F.col("place") <= F.col("cut_place")))
    return out.filter(F.coalesce(taken, F.lit(False))).select(
        F.col("doc_id").alias(doc_id), F.col("source").alias(source), "epoch", "block",
        F.col("__ll_tokens").alias("n_tokens"))


def oracle(mix: Mix = DEFAULT, documents: str = "documents") -> str:
    """The draws in plain SQL: one running sum per source, the exponent halved step by step."""
    if mix.tokens is not None:
        raise ValueError("the SQL is written for a budget of all tokens")
    return f"""
with recursive rows as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as n,
         coalesce(cast(doc_id as varchar), 'none') as id, md5(coalesce(text, '')) as m
  from {documents}),
sources as (
  select source, cast(sum(n) as bigint) as tokens, count(*) as docs from rows
  group by source having sum(n) > 0),
shares as (select source, tokens, docs, tokens / sum(tokens) over () as p,
                  sum(tokens) over () as total, count(*) over () as k from sources),
halved as (
  select 0 as step, cast(0 as double) as low, cast(1 as double) as high
  union all
  select step + 1,
         case when fits then low else mid end, case when fits then mid else high end
  from (select h.step, h.low, h.high, (h.low + h.high) / 2 as mid,
               (ln(sum(power(p, (h.low + h.high) / 2))) - (h.low + h.high) / 2
                  * sum(power(p, (h.low + h.high) / 2) * ln(p)) / sum(power(p, (h.low + h.high) / 2))
                <= {mix.entropy} * ln(max(k)) + 1e-12)
               and (max(power(p, (h.low + h.high) / 2 - 1)) / sum(power(p, (h.low + h.high) / 2))
                <= {mix.max_repeats} + 1e-12) as fits
        from halved h, shares where h.step < {HALVINGS * ROUNDS} group by h.step, h.low, h.high)),
zero as (
  select (ln(max(k)) <= {mix.entropy} * ln(max(k)) + 1e-12)
         and max(1 / p) / max(k) <= {mix.max_repeats} + 1e-12 as flat from shares),
chosen as (
  select case when (select flat from zero) then 0 else high end as a from halved
  where step = {HALVINGS * ROUNDS}),
goal as (
  select source, tokens, docs, cast(round(power(p, a) / (sum(power(p, a)) over ()) * total) as bigint)
         as target from shares, chosen),
cut as (
  select source, target // tokens as epochs, target % tokens as rest,
         cast(ceil(sqrt(docs)) as bigint) as blocks from goal),
draws as (
  select r.*, c.epochs, c.rest, c.blocks, unnest(range(0, c.epochs + 1)) as epoch
  from rows r join cut c on r.source is not distinct from c.source),
placed as (
  select *, md5('{mix.seed}|' || epoch || '|' || id) || m as place from draws),
blocked as (
  select *, cast('0x' || substr(place, 1, 12) as bigint) % blocks as block from placed),
summed as (
  select *, sum(n) over (partition by source, epoch order by block, place) as upto from blocked)
select doc_id, source, cast(epoch as int) as epoch, cast(block as bigint) as block,
       cast(n as bigint) as n_tokens
from summed where epoch < epochs or upto <= rest"""
