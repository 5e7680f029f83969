"""Preference formatting (DataFrame functions only).

A pair is two conversations, chosen and rejected. Their longest common prefix
of turns is rendered once, as the prompt; the turns after it are rendered as
two completions. Each completion comes with the spans to train on: the text
and end mark of assistant turns. Headers and the turns of other roles inside
a completion are masked.

Turns are grouped by conversation in one shuffle; all else works within a
row. A conversation is one output row, so its turns have to meet; nothing
else is grouped, and equal openings of many conversations make no hot key.

Defined results: a null role reads ``unknown``, a null text is empty; turns
are ordered by (turn, role, text), nulls first, and repeated rows stay; equal
sides give a prompt of all turns and empty completions; a missing side is a
side without turns; spans count code points, ends exclusive; an empty table
gives an empty result; conversations with a null id are one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table
from .common import let

HEAD, MID, END = "<|", "|>\n", "<|end|>\n"
TRAINED_ROLE = "assistant"
TURNS = "array<struct<role:string,text:string>>"


def gather(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, turns): the turns of each conversation in order."""
    turn = F.struct("turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.groupBy(key).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return rows.select(key, F.transform("turns", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias("turns"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(HEAD), t.role, F.lit(MID), t.text, F.lit(END))), "")


def _trained(turns: Column) -> Column:
    """``start:end`` of what is trained on in the rendered turns, comma-joined."""
    def step(s: Column, t: Column) -> Column:
        start = s.pos + len(HEAD) + F.length(t.role) + len(MID)
        end = start + F.length(t.text) + len(END)
        span = F.concat_ws(":", start.cast("string"), end.cast("string"))
        return F.struct(end.alias("pos"), F.when(t.role == TRAINED_ROLE, F.concat(s.out, F.array(span))).otherwise(s.out).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))
    return F.array_join(F.aggregate(turns, start, step, lambda s: s.out), ",")


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Prompt and masked completions of pairs of turn arrays.

    The two columns are replaced by n_prompt_turns, prompt, chosen, rejected,
    chosen_train and rejected_train; other columns stay.
    """
    side = lambda c: F.coalesce(F.col(f"`{c}`").cast(TURNS), F.array().cast(TURNS))

    def first_other(p: Column) -> Column:
        at = F.when(p.least > 0, F.sequence(F.lit(0), p.least - 1)).otherwise(F.array().cast("array<int>"))
        other = F.filter(at, lambda i: F.get(p.a, i) != F.get(p.b, i))
        return F.coalesce(F.get(other, F.lit(0)), p.least)

    def formatted(p: Column) -> Column:
        rest = lambda x: F.slice(x, p.k + 1, F.greatest(F.size(x) - p.k, F.lit(0)))
        return F.struct(
            p.k.cast("long").alias("n_prompt_turns"), _render(F.slice(p.a, F.lit(1), p.k)).alias("prompt"),
            _render(rest(p.a)).alias("chosen"), _render(rest(p.b)).alias("rejected"),
            _trained(rest(p.a)).alias("chosen_train"), _trained(rest(p.b)).alias("rejected_train"),
        )

    sides = F.struct(side(chosen).alias("a"), side(rejected).alias("b"), F.least(F.size(side(chosen)), F.size(side(rejected))).alias("least"))
    cut = let(sides, lambda p: F.struct(p.a.alias("a"), p.b.alias("b"), first_other(p).alias("k")))
    names = ["n_prompt_turns", "prompt", "chosen", "rejected", "chosen_train", "rejected_train"]
    kept = [F.col(f"`{c}`") for c in pairs.columns if c not in {chosen, rejected, *names}]
    return pairs.select(*kept, let(cut, formatted).alias("_pair")).select(*kept, *[F.col(f"_pair.{n}") for n in names])


def with_stale_reply(turns: Column) -> Column:
    """The conversation with its last assistant reply replaced by the one
    before it; without one before, the last reply is left out."""
    def swapped(t: Column) -> Column:
        at = F.filter(F.sequence(F.lit(1), F.size(t)), lambda i: F.get(t, i - 1).role == TRAINED_ROLE)
        return let(at, lambda a: let(
            F.struct(F.get(a, F.size(a) - 1).alias("last"), F.get(a, F.size(a) - 2).alias("before")),
            lambda x: F.when(x.last.isNull(), t).when(x.before.isNull(), F.filter(t, lambda _, i: i != x.last - 1)).otherwise(
                F.transform(t, lambda u, i: F.when(i == x.last - 1, F.get(t, x.before - 1)).otherwise(u))),
        ))

    return F.when(F.size(turns) > 0, let(turns, swapped)).otherwise(turns)


def op4_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with a stale last reply.

    The table holds no judged pairs: the conversation is the chosen side, and
    the same conversation that repeats its earlier reply the rejected one.
    """
    c = gather(read_table(spark, sf_dir, "conversations"))
    return format_pairs(c.select("conv_id", F.col("turns").alias("chosen"), with_stale_reply(F.col("turns")).alias("rejected")))


ORACLE = """
WITH c AS (
  SELECT conv_id, list({'role': coalesce(role, 'unknown'), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS a
  FROM conversations GROUP BY conv_id),
p AS (SELECT *, list_filter(range(1, len(a) + 1), lambda i: a[i].role = 'assistant') AS ix FROM c),
r AS (
  SELECT conv_id, a, CASE
    WHEN len(ix) = 0 THEN a
    WHEN len(ix) = 1 THEN list_transform(list_filter(range(1, len(a) + 1), lambda i: i <> ix[1]), lambda i: a[i])
    ELSE list_transform(range(1, len(a) + 1), lambda i: CASE WHEN i = ix[len(ix)] THEN a[ix[len(ix) - 1]] ELSE a[i] END) END AS b
  FROM p),
k AS (
  SELECT *, coalesce(list_min(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] <> b[i])) - 1, least(len(a), len(b))) AS k
  FROM r),
t AS (SELECT conv_id, k, a[1:k] AS p, a[k + 1:] AS a, b[k + 1:] AS b FROM k),
s AS (
  SELECT *, list_transform(p, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)) AS ps,
    list_transform(a, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)) AS sa,
    list_transform(b, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)) AS sb
  FROM t)
SELECT conv_id, k AS n_prompt_turns, list_aggregate(list_concat([''], ps), 'string_agg', '') AS prompt,
  list_aggregate(list_concat([''], sa), 'string_agg', '') AS chosen, list_aggregate(list_concat([''], sb), 'string_agg', '') AS rejected,
  coalesce(list_aggregate(list_concat([NULL], list_transform(list_filter(range(1, len(a) + 1), lambda i: a[i].role = 'assistant'),
    lambda i: (coalesce(list_sum(list_transform(sa[1:i], lambda x: len(x))), 0) - len(a[i].text) - 8)::BIGINT || ':' ||
         coalesce(list_sum(list_transform(sa[1:i], lambda x: len(x))), 0)::BIGINT)), 'string_agg', ','), '') AS chosen_train,
  coalesce(list_aggregate(list_concat([NULL], list_transform(list_filter(range(1, len(b) + 1), lambda i: b[i].role = 'assistant'),
    lambda i: (coalesce(list_sum(list_transform(sb[1:i], lambda x: len(x))), 0) - len(b[i].text) - 8)::BIGINT || ':' ||
         coalesce(list_sum(list_transform(sb[1:i], lambda x: len(x))), 0)::BIGINT)), 'string_agg', ','), '') AS rejected_train
FROM s
"""
