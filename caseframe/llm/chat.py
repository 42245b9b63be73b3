"""Preference pairs of conversations as prompt and masked completions.

The longest common turn prefix of the chosen and the rejected conversation is
rendered once, as prompt. What follows it on either side is that side's
completion, and a mask tells which characters of it to learn from: the
assistant's texts and the marks that end them. All of it is column expressions
on one array of turns per conversation.

A conversation's turns are ordered by turn, role and text; rows that repeat all
three count once. Nulls: a null role is ``unknown``, a null text is empty, a
null turn comes first, and rows without a conversation id are left out, as
nothing says whose they are. ``<|`` inside a text is written ``< |``, so texts
cannot end a turn. Equal conversations have empty completions, conversations
that differ from their first turn on an empty prompt, and a pair one of whose
conversations is missing is left out. Extra columns are ignored; an empty table
gives an empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNT = "assistant"


def _turns(conversations: DataFrame) -> DataFrame:
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return (
        conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("one"))
        .filter("conv_id is not null")
        .groupBy("conv_id")
        .agg(F.sort_array(F.array_distinct(F.collect_list("one"))).alias("turns"))
    )


def _rendered(turns: Column) -> Column:
    """A struct of header and body for each turn, and whether it is learnt."""
    return F.transform(
        turns,
        lambda turn: F.struct(
            F.concat(F.lit("<|"), turn["role"], F.lit("|>\n")).alias("header"),
            F.concat(F.replace(turn["text"], F.lit("<|"), F.lit("< |")), F.lit("<|end|>\n")).alias(
                "body"
            ),
            (turn["role"] == LEARNT).alias("learnt"),
        ),
    )


def _text(turns: Column) -> Column:
    pieces = F.transform(_rendered(turns), lambda turn: F.concat(turn["header"], turn["body"]))
    return F.array_join(pieces, "")


def _mask(turns: Column) -> Column:
    """Start and end of the characters to learn from."""
    empty = F.struct(
        F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start: int, end: int>>)").alias("spans")
    )

    def add(total, turn):
        start = total["at"] + F.length(turn["header"])
        end = start + F.length(turn["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"),
            F.when(turn["learnt"], F.concat(total["spans"], span))
            .otherwise(total["spans"])
            .alias("spans"),
        )

    return F.aggregate(_rendered(turns), empty, add, lambda total: total["spans"])


def adjacent_pairs(conversations: DataFrame) -> DataFrame:
    """Conversations 2i and 2i + 1 as chosen and rejected."""
    ids = (
        conversations.select(F.col("conv_id").cast("long").alias("conv_id"))
        .filter("conv_id is not null")
        .distinct()
    )
    return (
        ids.groupBy(F.expr("conv_id - pmod(conv_id, 2)").alias("chosen_id"))
        .agg(F.count("*").alias("n"))
        .filter("n = 2")
        .select("chosen_id", (F.col("chosen_id") + 1).alias("rejected_id"))
    )


def preference_pairs(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """Prompt, completions and masks of ``chosen_id`` and ``rejected_id``."""
    turns = _turns(conversations)
    sides = pairs.select(
        F.col("chosen_id").cast("long").alias("chosen_id"),
        F.col("rejected_id").cast("long").alias("rejected_id"),
    )
    for side in ("chosen", "rejected"):
        sides = sides.join(
            turns.select(F.col("conv_id").alias(f"{side}_id"), F.col("turns").alias(side)),
            f"{side}_id",
        )
    differing = F.expr(
        "array_min(filter(sequence(1, greatest(size(chosen), size(rejected))), i ->"
        " not ((get(chosen, i - 1).role <=> get(rejected, i - 1).role)"
        " and (get(chosen, i - 1).text <=> get(rejected, i - 1).text))))"
    )
    sides = sides.withColumn("n_common", F.coalesce(differing - 1, F.size("chosen")))

    def rest(side):
        return F.expr(f"slice({side}, n_common + 1, size({side}))")

    return sides.select(
        "chosen_id",
        "rejected_id",
        "n_common",
        _text(F.expr("slice(chosen, 1, n_common)")).alias("prompt"),
        _text(rest("chosen")).alias("chosen"),
        _mask(rest("chosen")).alias("chosen_mask"),
        _text(rest("rejected")).alias("rejected"),
        _mask(rest("rejected")).alias("rejected_mask"),
    )
