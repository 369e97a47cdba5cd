"""Preference pairs: one prompt, two completions with loss masks.

The longest common prefix of the turns of the chosen and the rejected conversation is rendered
once as the prompt; what follows in each is its completion. A mask says which characters train
the model: the text and the end mark of assistant turns. Masks are run lengths, so their size
and cost follow the number of turns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossloom.llm.storage import stored

TURNS = "array<struct<role:string,text:string>>"
RUNS = "array<struct<chars:int,loss:boolean>>"
ADDED = ("n_prompt_turns", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask")


@dataclass(frozen=True)
class Template:
    """Marks around a turn, and the role whose turns are learned."""
    before: str = "<|"
    after: str = "|>\n"
    end: str = "<|end|>\n"
    learned: str = "assistant"


DEFAULT = Template()


def conversations(turns: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """(conv_id, turns): one row per conversation, turns in order of (turn, role, text).

    Rows alike in all of these are one turn; null roles and texts stay null. A conversation is
    one training example, so its turns meet in one row, as the text of a document does. A row without
    an id is a conversation of its own: nothing says which others it belongs to, so such rows
    are not gathered. Ids may be numbers or text; an empty table gives no rows.
    """
    row = F.struct(F.col("turn"), F.col("role").cast("string").alias("role"),
                   F.col("text").cast("string").alias("text"))
    named = turns.filter(F.col(conv_id).isNotNull()).groupBy(conv_id).agg(
        F.sort_array(F.collect_list(row)).alias("__ll_t")).select(
        conv_id, F.transform(F.array_distinct("__ll_t"), lambda x: F.struct(
            x["role"].alias("role"), x["text"].alias("text"))).cast(TURNS).alias("turns"))
    single = turns.filter(F.col(conv_id).isNull()).select(conv_id, F.array(F.struct(
        row["role"].alias("role"), row["text"].alias("text"))).cast(TURNS).alias("turns"))
    return named.unionByName(single)


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns with equal roles and texts (nulls equal nulls)."""
    same = F.zip_with(a, b, lambda x, y: x.isNotNull() & y.isNotNull() & x["role"].eqNullSafe(
        y["role"]) & x["text"].eqNullSafe(y["text"]))
    first = F.array_position(same, F.lit(False)).cast("int")
    return F.when(first > 0, first - 1).otherwise(F.size(same))


def _text(x: Column) -> Column:
    return F.coalesce(x["text"], F.lit(""))


def _head(x: Column, t: Template) -> Column:
    return F.concat(F.lit(t.before), F.coalesce(x["role"], F.lit("")), F.lit(t.after))


def render(turns: Column, t: Template = DEFAULT) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(
        _head(x, t), _text(x), F.lit(t.end))), "")


def loss_runs(turns: Column, t: Template = DEFAULT) -> Column:
    """Run lengths over the rendered turns: marks without loss, then text and end mark."""
    return F.flatten(F.transform(turns, lambda x: F.array(
        F.struct(F.length(_head(x, t)).alias("chars"), F.lit(False).alias("loss")),
        F.struct((F.length(_text(x)) + len(t.end)).alias("chars"),
                 F.coalesce(x["role"] == t.learned, F.lit(False)).alias("loss"))))).cast(RUNS)


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected",
                 t: Template = DEFAULT) -> DataFrame:
    """``pairs`` with turns replaced: adds n_prompt_turns, prompt, chosen, rejected and masks.

    A null or empty conversation has no turns. Equal conversations have empty completions; if one
    is a prefix of the other, its completion is empty. Rows are independent, so repeated ones are
    formatted each and an empty table gives no rows: no shuffle. Columns of ``pairs`` with the name of
    an added one are replaced; all others pass through.
    """
    none = F.array().cast(TURNS)
    ready = pairs.withColumns({"__ll_a": F.coalesce(F.col(chosen), none),
                               "__ll_b": F.coalesce(F.col(rejected), none)})
    n = F.col("__ll_n")
    cut = ready.withColumn("__ll_n", common_turns(F.col("__ll_a"), F.col("__ll_b")))
    rest = cut.withColumns({
        "__ll_p": F.slice("__ll_a", F.lit(1), n),
        "__ll_a": F.slice("__ll_a", n + 1, F.size("__ll_a")),
        "__ll_b": F.slice("__ll_b", n + 1, F.size("__ll_b"))})
    keep = [c for c in pairs.columns if c not in (chosen, rejected, *ADDED)]
    return rest.select(
        *keep, n.alias("n_prompt_turns"), render(F.col("__ll_p"), t).alias("prompt"),
        render(F.col("__ll_a"), t).alias("chosen"), render(F.col("__ll_b"), t).alias("rejected"),
        loss_runs(F.col("__ll_a"), t).alias("chosen_mask"),
        loss_runs(F.col("__ll_b"), t).alias("rejected_mask"))


def next_ids(ids: DataFrame, conv_id: str) -> DataFrame:
    """``ids`` (unique, not null) with ``__ll_next``: the next larger id, null for the last.

    Ids are dealt to ranges in order. Within a range the next id is one row on; the last id of a
    range takes the first one of a later range, from a table of one row per range.
    """
    ranged = stored(ids.repartitionByRange(conv_id).withColumn("__ll_range", F.spark_partition_id()))
    firsts = ranged.groupBy("__ll_range").agg(F.min(conv_id).alias("__ll_first"))
    later = Window.orderBy("__ll_range").rowsBetween(1, Window.unboundedFollowing)
    carry = firsts.select("__ll_range", F.min("__ll_first").over(later).alias("__ll_carry"))
    own = Window.partitionBy("__ll_range").orderBy(conv_id)
    return ranged.withColumn("__ll_next", F.lead(conv_id).over(own)).join(
        F.broadcast(carry), "__ll_range").select(
        conv_id, F.coalesce("__ll_next", "__ll_carry").alias("__ll_next"))


def rejected_replies(convs: DataFrame, conv_id: str = "conv_id",
                     t: Template = DEFAULT) -> DataFrame:
    """(conv_id, chosen, rejected): pairs made from a table that has no rejected replies.

    Chosen is the conversation. Rejected has the same turns up to its last learned turn, then the
    last learned turn of the conversation with the next id that has one, whatever ids lie between;
    the last such conversation, and one without an id, get none. A conversation without a learned
    turn is paired with itself. Each id is the next of at most one other, so no join has a hot key.
    """
    places = F.transform("turns", lambda x, i: F.when(x["role"] == t.learned, i + 1).otherwise(0))
    own = stored(convs.withColumn("__ll_last", F.coalesce(F.array_max(places), F.lit(0))))
    learned = own.filter((F.col("__ll_last") > 0) & F.col(conv_id).isNotNull())
    donors = learned.select(F.col(conv_id).alias("__ll_next"),
                            F.slice("turns", F.col("__ll_last"), 1).alias("__ll_reply"))
    replies = next_ids(learned.select(conv_id), conv_id).join(donors, "__ll_next").drop("__ll_next")
    prefix = F.slice("turns", F.lit(1), F.greatest(F.col("__ll_last") - 1, F.lit(0)))
    return own.join(replies, conv_id, "left").select(
        conv_id, F.col("turns").alias("chosen"),
        F.when(F.col("__ll_last") == 0, F.col("turns")).otherwise(F.concat(
            prefix, F.coalesce("__ll_reply", F.array().cast(TURNS)))).alias("rejected"))


def mask_text(mask: str) -> Column:
    """Run lengths as text: chars:loss, comma-joined."""
    return F.array_join(F.transform(mask, lambda x: F.concat_ws(
        ":", x["chars"], x["loss"].cast("int"))), ",")


def digest(formatted: DataFrame) -> DataFrame:
    return formatted.withColumns({"chosen_mask": mask_text("chosen_mask"),
                                  "rejected_mask": mask_text("rejected_mask")})


def oracle(t: Template = DEFAULT) -> str:
    """The pairs of ``rejected_replies`` in plain SQL, where the common prefix is known."""
    line = lambda s: s.replace("\n", "' || chr(10) || '")
    head = f"'{t.before}' || coalesce(x.role, '') || '{line(t.after)}'"
    render_ = (f"coalesce(array_to_string(list_transform({{}}, lambda x: {head} || "
               f"coalesce(x.text, '') || '{line(t.end)}'), ''), '')")
    mask = (f"coalesce(array_to_string(list_transform({{}}, lambda x: length({head}) || ':0,' || "
            f"(length(coalesce(x.text, '')) + {len(t.end)}) || ':' || "
            f"(case when x.role = '{t.learned}' then 1 else 0 end)), ','), '')")
    return f"""
with rows as (select distinct conv_id, turn, role, text from conversations where conv_id is not null),
convs as (
  select conv_id, list({{'role': role, 'text': text}} order by turn nulls first, role nulls first,
                      text nulls first) as turns
  from rows group by conv_id
  union all
  select conv_id, [{{'role': role, 'text': text}}] from conversations where conv_id is null),
own as (
  select *, coalesce(list_max(list_transform(turns, lambda x, i:
      case when x.role = '{t.learned}' then i else 0 end)), 0) as last from convs),
donors as (
  select conv_id, lead(turns[last]) over (order by conv_id) as reply,
         lead(conv_id) over (order by conv_id) is not null as has
  from own where last > 0 and conv_id is not null),
pairs as (
  select o.conv_id, o.turns, o.last, d.reply, coalesce(d.has, false) as has, o.turns[o.last] as mine
  from own o left join donors d on d.conv_id = o.conv_id),
cut as (
  select *, case when last = 0 then len(turns)
                 when has and reply.text is not distinct from mine.text then last
                 else last - 1 end as n from pairs),
parts as (
  select conv_id, n, turns[1:n] as p, turns[n + 1:] as a,
         case when last > 0 and has and n = last - 1 then [reply] else [] end as b from cut)
select conv_id, cast(n as int) as n_prompt_turns, {render_.format('p')} as prompt,
       {render_.format('a')} as chosen, {render_.format('b')} as rejected,
       {mask.format('a')} as chosen_mask, {mask.format('b')} as rejected_mask
from parts"""
