"""Preference pairs: a shared prompt and two completions with loss masks.

The longest common prefix of turns of the chosen and the rejected conversation is rendered once, as
the prompt; what follows on either side is a completion. A completion's mask is the list of
character spans that carry loss: the texts of the assistant's turns with their end mark. A turn is
rendered by a fixed template, so prompt and completion concatenate to the rendered conversation. Places
of spans come from sums of lengths in two levels, so their cost does not grow with a conversation's
square.

A conversation is gathered by one shuffle on its id and is then worked on within its row, all in
the JVM. What a row holds is one conversation, as the result's row does.

Defined results: a null role or text counts as "". Rows that repeat are turns of their own; equal
turn numbers are ordered by role and text. If one conversation is a prefix of the other, or both
are equal, the completion of the shorter is empty and has no spans. A row with a null conv_id belongs
to no other: it is a conversation of one turn, without a partner. Other columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE, LEARNED = "<|", "|>\n", "<|end|>\n", "assistant"
#: Turns whose lengths are added up together.
BLOCK = 256


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and turns, an array of (role, text) in order."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    rows = rows.unionByName(turns.where(F.col("conv_id").isNull()).select("conv_id", F.array(turn).alias("t")))
    return rows.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def render(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE), turn["text"], F.lit(CLOSE))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, render), "")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value made once although it is used inside of lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _total(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0), lambda a, x: a + x)


def _spans(turns: Column) -> Column:
    """(start, end) of what carries loss in the rendered turns."""
    fixed = len(OPEN) + len(MIDDLE) + len(CLOSE)
    sizes = F.transform(turns, lambda x: F.length(x["role"]) + F.length(x["text"]) + fixed)
    numbered = F.filter(F.transform(turns, lambda x, i: F.struct(x["role"].alias("role"), i.alias("i"))), lambda n: n["role"] == LEARNED)

    def with_starts(sizes: Column, starts: Column) -> Column:
        def span(n: Column) -> Column:
            block = F.floor(n["i"] / BLOCK).cast("int")
            before = F.get(starts, block) + _total(F.slice(sizes, block * BLOCK + 1, n["i"] % BLOCK))
            head = len(OPEN) + len(MIDDLE) + F.length(n["role"])
            return F.struct((before + head).alias("start"), (before + F.get(sizes, n["i"])).alias("end"))

        return F.transform(numbered, span)

    def with_sizes(sizes: Column) -> Column:
        n_blocks = F.ceil(F.size(sizes) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(n_blocks - 1, F.lit(0))), lambda b: _total(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))))
        starts = F.aggregate(blocks, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return _let(starts, lambda starts: with_starts(sizes, starts))

    return _let(sizes, with_sizes)


def format_pairs(pairs: DataFrame) -> DataFrame:
    """pairs: pair_id, chosen and rejected, arrays of (role, text). Gives pair_id, n_prompt_turns,
    prompt, chosen, rejected, chosen_spans and rejected_spans."""
    none = lambda c: F.coalesce(F.col(c), F.array().cast("array<struct<role:string,text:string>>"))
    rows = pairs.select("pair_id", none("chosen").alias("c"), none("rejected").alias("r"))
    differs = F.array_position(F.zip_with("c", "r", lambda a, b: ~a.eqNullSafe(b)), F.lit(True))
    rows = rows.withColumn("n", F.when(differs > 0, differs - 1).otherwise(F.least(F.size("c"), F.size("r"))).cast("int"))
    rest = lambda c: F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    rows = rows.select("pair_id", "n", F.slice("c", F.lit(1), F.col("n")).alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    return rows.select(
        "pair_id", F.col("n").alias("n_prompt_turns"), _rendered(F.col("p")).alias("prompt"),
        _rendered(F.col("c")).alias("chosen"), _rendered(F.col("r")).alias("rejected"),
        _spans(F.col("c")).alias("chosen_spans"), _spans(F.col("r")).alias("rejected_spans"),
    )


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Pairs made of a table of conversations: chosen is the conversation; rejected is the same with
    the last turn of its partner, the conversation whose id differs in the lowest bit, in place of
    its own last turn (or without a last turn, if there is no partner)."""
    talks = conversations(turns)
    partner = talks.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("_id"), F.slice("turns", F.size("turns"), F.lit(1)).alias("_last"))
    rows = talks.join(partner, F.col("conv_id") == F.col("_id"), "left")
    rejected = F.concat(F.slice("turns", F.lit(1), F.size("turns") - 1), F.coalesce("_last", F.slice("turns", F.lit(1), F.lit(0))))
    return rows.select(F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"), rejected.alias("rejected"))
