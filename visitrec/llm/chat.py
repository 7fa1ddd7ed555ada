"""Preference formatting: what two conversations share is rendered once, as the prompt.

The turns of both conversations are put in order; the longest run of equal turns from the start is the
prompt. What follows in each is its completion, with the places of the assistant's words: those are trained
on, all else is masked. One conversation is one record and so one row; pairs are dealt by pair_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed format of a turn: a line with the role, the text, an end mark.
HEAD, BREAK, TAIL = "<|", "|>\n", "<|end|>\n"


def _clean(text: Column) -> Column:
    """Marks inside a text are broken up, so that only the format's own are marks."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), _clean(turn["role"]), F.lit(BREAK))


def _rendered(turns: Column) -> Column:
    """The text of some turns."""
    return F.array_join(
        F.transform(turns, lambda t: F.concat(_head(t), _clean(t["text"]), F.lit(TAIL))), ""
    )


def _trained(turns: Column, role: str) -> Column:
    """Start and end, in characters of the completion, of each turn that ``role`` speaks, its end mark included."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(done: Column, turn: Column) -> Column:
        start = done["at"] + F.length(_head(turn))
        end = start + F.length(_clean(turn["text"])) + len(TAIL) - 1
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            (end + 1).alias("at"),
            F.when(turn["role"] == role, F.concat(done["spans"], span))
            .otherwise(done["spans"])
            .alias("spans"),
        )

    return F.aggregate(turns, empty, step, lambda done: done["spans"])


def _conversations(turns: DataFrame, side: str) -> DataFrame:
    turn = F.struct("turn", "role", "text")
    return (
        turns.filter("pair_id IS NOT NULL")
        .groupBy("pair_id")
        .agg(F.sort_array(F.collect_list(turn)).alias(side))
    )


def preference_pairs(chosen: DataFrame, rejected: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Pair two tables of turns (pair_id, turn, role, text).

    Turns are equal if role and text are; null equals null. Returns for each pair_id of both tables: pair_id,
    n_prompt_turns, prompt, chosen, rejected, and chosen_spans and rejected_spans (start and end, in
    characters, of what is trained on). A null role or text renders as empty. Turns with the same number
    keep the order of role and text, nulls first. Rows without a pair_id, and pairs with one side only, are
    left out. If one conversation is the start of the other, its completion is empty. Other columns are
    ignored.
    """
    both = _conversations(chosen, "a").join(_conversations(rejected, "b"), "pair_id")
    differs = F.array_position(
        F.zip_with(
            "a",
            "b",
            lambda x, y: x.isNotNull()
            & y.isNotNull()
            & x["role"].eqNullSafe(y["role"])
            & x["text"].eqNullSafe(y["text"]),
        ),
        False,
    )
    shared = F.when(differs > 0, differs - 1).otherwise(F.size("a")).cast("int")
    both = both.withColumn("shared", shared)

    def rest(side: str) -> Column:
        return F.slice(side, F.col("shared") + 1, F.greatest(F.size(side) - F.col("shared"), F.lit(0)))

    return both.select(
        "pair_id",
        F.col("shared").alias("n_prompt_turns"),
        _rendered(F.slice("a", F.lit(1), F.col("shared"))).alias("prompt"),
        _rendered(rest("a")).alias("chosen"),
        _rendered(rest("b")).alias("rejected"),
        _trained(rest("a"), trained_role).alias("chosen_spans"),
        _trained(rest("b"), trained_role).alias("rejected_spans"),
    )
