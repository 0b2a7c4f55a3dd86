"""Preference formatting of conversations, in DataFrame functions only.

The longest common prefix of turns of a chosen and a rejected conversation is rendered once as the
prompt; what follows in each is its completion, with the spans that a loss counts: the assistant's turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm.common import table

#: The public ChatML markers.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _render(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit("\n"), F.coalesce(turn["text"], F.lit("")), F.lit(CLOSE))


def _head(turn: Column) -> Column:
    return F.length(F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit("\n")))


def conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """conv_id, turns: the turns of each conversation in order. A conversation is one row and so must fit a task."""
    turn = F.struct(F.col("turn"), F.col("role"), F.col("text"))
    return turns.groupBy(F.col(key).alias("conv_id")).agg(F.sort_array(F.collect_set(turn)).alias("turns"))


def with_other_reply(turns: Column) -> Column:
    """A conversation up to its last assistant turn, with that turn's text replaced by the first assistant turn's, or
    by the empty text if that is the same turn; without an assistant turn the conversation as it is."""
    replies = F.filter(F.sequence(F.lit(1), F.size(turns)), lambda i: F.element_at(turns, i.cast("int"))["role"] == "assistant")
    last, first = F.get(replies, F.size(replies) - 1).cast("int"), F.get(replies, F.lit(0)).cast("int")
    old = F.element_at(turns, last)
    new = F.struct(old["turn"].alias("turn"), old["role"].alias("role"), F.when(last == first, "").otherwise(F.element_at(turns, first)["text"]).alias("text"))
    return F.when(F.size(replies) > 0, F.concat(F.slice(turns, F.lit(1), last - 1), F.array(new))).otherwise(turns)


def preferences(chosen: DataFrame, rejected: DataFrame, on: tuple[str, ...] = ("pair_id",)) -> DataFrame:
    """One row per pair of chosen and rejected (`on` columns, turns): prompt_turns, prompt, and for either side
    the completion and its mask "start:end" spans (code points in the completion, end exclusive).

    Turns are equal when role and text are, nulls included. Repeated rows of a turn count once; turns with
    one number are ordered by role and text; null numbers come first; null roles and texts render as empty.
    A pair that lacks a side has no prompt turns and a null completion there; equal sides are all prompt, with
    empty completions. Texts of any length are rendered whole. Other columns are not read. Empty tables give no rows.
    """
    both = chosen.select(*on, F.col("turns").alias("c")).join(rejected.select(*on, F.col("turns").alias("r")), list(on), "full")
    same = lambda i: F.col("c")[i]["role"].eqNullSafe(F.col("r")[i]["role"]) & F.col("c")[i]["text"].eqNullSafe(F.col("r")[i]["text"])
    shorter = F.least(F.size("c"), F.size("r"))
    differs = F.filter(F.sequence(F.lit(0), shorter - 1), lambda i: ~same(i))
    prefix = F.when(F.col("c").isNull() | F.col("r").isNull() | (shorter < 1), 0).otherwise(F.coalesce(F.get(differs, F.lit(0)), shorter))
    pairs = both.withColumn("prompt_turns", prefix.cast("int"))

    def side(name: str) -> tuple[Column, Column]:
        rest = F.slice(F.col(name), F.col("prompt_turns") + 1, F.greatest(F.size(name), F.lit(1)))
        text = F.when(F.col(name).isNotNull(), F.concat_ws("", F.transform(rest, _render)))
        spans = F.aggregate(
            rest,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
            lambda a, t: F.struct(
                (a["at"] + F.length(_render(t))).alias("at"),
                F.when(t["role"] == "assistant", F.concat(a["out"], F.array(F.concat_ws(":", a["at"] + _head(t), a["at"] + F.length(_render(t)))))).otherwise(a["out"]).alias("out"),
            ),
            lambda a: F.concat_ws(",", a["out"]),
        )
        return text, spans

    (c_text, c_mask), (r_text, r_mask) = side("c"), side("r")
    return pairs.select(
        *on, "prompt_turns", F.concat_ws("", F.transform(F.slice("c", 1, F.col("prompt_turns")), _render)).alias("prompt"),
        c_text.alias("chosen"), F.when(F.col("c").isNotNull(), c_mask).alias("chosen_mask"),
        r_text.alias("rejected"), F.when(F.col("r").isNotNull(), r_mask).alias("rejected_mask"),
    )


def op8_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pairings of all conversations. `reply`: a conversation with its last reply, and with another reply of
    its assistant in that place, so that all turns before are the prompt. `sibling`: conversations 2k and 2k + 1."""
    whole = conversations(table(spark, sf_dir, "conversations")).where("conv_id is not null")
    named = lambda df, name, pair: df.select(F.lit(name).alias("pairing"), pair.cast("long").alias("pair_id"), "turns")
    own, pair = F.col("conv_id"), F.floor(F.col("conv_id") / 2)
    chosen = named(whole, "reply", own).unionByName(named(whole.where("conv_id % 2 = 0"), "sibling", pair))
    rejected = named(whole.withColumn("turns", with_other_reply(F.col("turns"))), "reply", own).unionByName(named(whole.where("conv_id % 2 <> 0"), "sibling", pair))
    return preferences(chosen, rejected, ("pairing", "pair_id"))


ORACLE = r"""
with d as (select distinct conv_id, turn, role, text from conversations where conv_id is not null),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as k from d),
a as (select conv_id, max(k) as la, min(k) as fa, arg_min(coalesce(text, chr(0)), k) as reply from o where role = 'assistant' group by conv_id),
u as (select 'sibling' as pairing, conv_id // 2 as pair_id, conv_id % 2 as side, k, role, text from o
  union all select 'reply', conv_id, 0, k, role, text from o
  union all select 'reply', o.conv_id, 1, k, role, case when k = la then case when la = fa then '' else nullif(reply, chr(0)) end else text end from o left join a on o.conv_id = a.conv_id where la is null or k <= la),
t as (select pairing, pair_id, side, k, role, text, '<|im_start|>' || coalesce(role, '') || chr(10) as head, coalesce(text, '') || '<|im_end|>' || chr(10) as body from u),
s as (select pairing, pair_id, max(case when side = 0 then k end) as nc, max(case when side = 1 then k end) as nr from t group by 1, 2),
x as (select a.pairing, a.pair_id, min(a.k) as bad from t a join t b on a.pairing = b.pairing and a.pair_id = b.pair_id and a.k = b.k and a.side = 0 and b.side = 1
  where a.role is distinct from b.role or a.text is distinct from b.text group by 1, 2),
p as (select s.pairing, s.pair_id, nc, nr, case when nc is null or nr is null then 0 else coalesce(bad - 1, least(nc, nr)) end as prompt_turns from s left join x on s.pairing = x.pairing and s.pair_id = x.pair_id),
c as (select t.*, prompt_turns, coalesce(sum(length(head) + length(body)) over (partition by t.pairing, t.pair_id, side, k > prompt_turns order by k rows between unbounded preceding and 1 preceding), 0) as place
  from t join p on t.pairing = p.pairing and t.pair_id = p.pair_id)
select p.pairing, p.pair_id, cast(p.prompt_turns as int) as prompt_turns,
  coalesce(string_agg(case when side = 0 and k <= c.prompt_turns then head || body end, '' order by k), '') as prompt,
  case when nc is not null then coalesce(string_agg(case when side = 0 and k > c.prompt_turns then head || body end, '' order by k), '') end as chosen,
  case when nc is not null then coalesce(string_agg(case when side = 0 and k > c.prompt_turns and role = 'assistant' then (place + length(head)) || ':' || (place + length(head) + length(body)) end, ',' order by k), '') end as chosen_mask,
  case when nr is not null then coalesce(string_agg(case when side = 1 and k > c.prompt_turns then head || body end, '' order by k), '') end as rejected,
  case when nr is not null then coalesce(string_agg(case when side = 1 and k > c.prompt_turns and role = 'assistant' then (place + length(head)) || ':' || (place + length(head) + length(body)) end, ',' order by k), '') end as rejected_mask
from p join c on p.pairing = c.pairing and p.pair_id = c.pair_id group by p.pairing, p.pair_id, p.prompt_turns, nc, nr
"""
