"""The chat operators for tables that hold one row per turn.

A stored chat record is one array and fits a row. A table of single turns has no such bound: one
conversation may hold a large part of it. Here turns stay rows. Per conversation only small
aggregates are computed, with partial aggregation before the shuffle, and joined back per range of
turns, so that a long conversation is spread over many tasks. No turns are collected into arrays.
Turns whose ``conv_id`` is null are one conversation.

Columns: ``conv_id, turn, role, content``; ``(conv_id, turn)`` is unique, turns count up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatprep.functions.chat import CHATML, DEFAULT_SYSTEM_PROMPT, Template, render_message
from chatprep.operators.joins import null_safe_join

COLUMNS = ("conv_id", "turn", "role", "content")
TURNS_PER_RANGE = 1 << 16


def _assistant() -> Column:
    return F.col("role").eqNullSafe("assistant")


def first_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, first_turn, has_system)``; all in numbers, which hash aggregation can hold."""
    system = F.when(F.col("role") == "system", F.col("turn"))
    return turns.groupBy("conv_id").agg(
        F.min("turn").alias("first_turn"),
        F.min(system).eqNullSafe(F.min("turn")).alias("has_system"),
    )


def _system_rows(first: DataFrame, prompt: str) -> DataFrame:
    return first.select(
        "conv_id",
        (F.col("first_turn") - 1).alias("turn"),
        F.lit("system").alias("role"),
        F.lit(prompt).alias("content"),
    )


def ensure_system(turns: DataFrame, prompt: str = DEFAULT_SYSTEM_PROMPT) -> DataFrame:
    lacking = first_turns(turns).where(~F.col("has_system"))
    return turns.select(*COLUMNS).unionByName(_system_rows(lacking, prompt))


def prepend_system(turns: DataFrame, prompt: str = DEFAULT_SYSTEM_PROMPT) -> DataFrame:
    return turns.select(*COLUMNS).unionByName(_system_rows(first_turns(turns), prompt))


def append_turn(turns: DataFrame, role: str, contents: DataFrame) -> DataFrame:
    """``contents(conv_id, content)`` as a last turn of its conversation."""
    last = turns.groupBy("conv_id").agg((F.max("turn") + 1).alias("turn"))
    added = null_safe_join(last, contents, ["conv_id"]).withColumn("role", F.lit(role))
    return turns.select(*COLUMNS).unionByName(added.select(*COLUMNS))


def render_turns(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """The piece of training text of each turn; in turn order they make up the conversation's."""
    text = render_message(F.col("role"), F.col("content"), template)
    return turns.select("conv_id", "turn", text.alias("text"))


def _with_bounds(turns: DataFrame, bounds: DataFrame) -> DataFrame:
    """Turns joined with their conversation's row of ``bounds(conv_id, first, last, ...)``, for the
    turns from ``first`` to ``last``.

    Both sides are keyed by conversation and range of turns; nearly all conversations lie in one.
    Only ranges that have turns are made, so turns may be as far apart as time stamps.
    """

    def range_of(turn: str) -> Column:
        return F.expr(f"{turn} div {TURNS_PER_RANGE}")

    ranges = turns.select("conv_id", range_of("turn").alias("_range")).distinct()
    inside = (F.col("_range") >= range_of("first")) & (F.col("_range") <= range_of("last"))
    spread = null_safe_join(ranges, bounds, ["conv_id"]).where(inside)
    ranged = turns.withColumn("_range", range_of("turn"))
    return (
        null_safe_join(ranged, spread, ["conv_id", "_range"])
        .where((F.col("turn") >= F.col("first")) & (F.col("turn") <= F.col("last")))
        .drop("_range")
    )


def answer_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, first_turn, answer_turn)``: where the prompt begins and its first answer comes,
    for conversations that have an answer. Texts are not read."""
    asked = F.when(~_assistant(), F.col("turn"))
    bounds = turns.groupBy("conv_id").agg(F.min(asked).alias("first"), F.max("turn").alias("last"))
    answers = _with_bounds(
        turns.where(_assistant()).select("conv_id", "turn"), bounds.where("first IS NOT NULL")
    )
    return answers.groupBy("conv_id", F.col("first").alias("first_turn")).agg(
        F.min("turn").alias("answer_turn")
    )


def _answers(turns: DataFrame) -> DataFrame:
    return turns.where(_assistant() & (F.length("content") > 0)).select(
        "conv_id",
        F.col("turn").alias("answer_turn"),
        F.col("content").alias("expected_response"),
    )


def eval_pairs(turns: DataFrame) -> DataFrame:
    """``(conv_id, first_turn, answer_turn, expected_response)`` of conversations that have one.

    The prompt is the turns from ``first_turn`` up to, but without, ``answer_turn``.
    """
    pairs = null_safe_join(answer_turns(turns), _answers(turns), ["conv_id", "answer_turn"])
    return pairs.select("conv_id", "first_turn", "answer_turn", "expected_response")


def eval_pairs_sized(turns: DataFrame) -> DataFrame:
    """``eval_pairs`` with ``prompt_turns``, the number of turns of the prompt.

    Answers are looked for once; the prompts are counted from there, in numbers alone, and the
    expected responses are fetched last.
    """
    bounds = answer_turns(turns).select(
        "conv_id",
        F.col("first_turn").alias("first"),
        (F.col("answer_turn") - 1).alias("last"),
        "answer_turn",
    )
    sized = (
        _with_bounds(turns.select("conv_id", "turn"), bounds)
        .groupBy("conv_id", F.col("first").alias("first_turn"), "answer_turn")
        .agg(F.count(F.lit(1)).alias("prompt_turns"))
    )
    return null_safe_join(sized, _answers(turns), ["conv_id", "answer_turn"])


def prompt_turns(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """The turns of each evaluation prompt."""
    bounds = pairs.select(
        "conv_id", F.col("first_turn").alias("first"), (F.col("answer_turn") - 1).alias("last")
    )
    return _with_bounds(turns, bounds).select(*COLUMNS)


def conversation_prompt(turns: DataFrame) -> DataFrame:
    """Turns that are not the assistant's, or that say the same as the conversation's first."""
    spoken = F.when(_assistant(), F.col("turn"))
    opening = turns.groupBy("conv_id").agg(
        F.min("turn").alias("first"),
        F.max("turn").alias("last"),
        F.min(spoken).alias("first_spoken"),
    )
    # Only conversations that the assistant opens can repeat its first words.
    opened = opening.where("first = first_spoken").drop("first_spoken")
    assistant = turns.where(_assistant())
    words = assistant.select(
        "conv_id", F.col("turn").alias("first"), F.col("content").alias("first_content")
    )
    opened = null_safe_join(opened, words, ["conv_id", "first"])
    repeated = _with_bounds(assistant, opened).where(
        F.col("content").eqNullSafe(F.col("first_content"))
    )
    return turns.where(~_assistant()).select(*COLUMNS).unionByName(repeated.select(*COLUMNS))
