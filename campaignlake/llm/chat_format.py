"""Preference pairs for chat models, in DataFrame functions only.

A pair is two conversations, chosen and rejected.  Their longest common prefix
of turns (same role and text) is rendered once, as the prompt; what follows in
each is its completion.  A mask goes with each completion: the character spans
that the loss counts, which are the assistant's texts with their end mark.

    <|im_start|>role
    text<|im_end|>

``<|`` inside a role or text is written ``< |``, so that no text can open or
close a turn.

Defined results: turns sort by number, then role, then text, nulls first, and
repeated turns stay; a null role reads as ``user`` and a null text as empty;
turns without a pair id belong to no pair; a side that is missing has no turns;
equal sides give two empty completions with empty masks.
A pair is one training example and one output row, so the turns of one pair
(not of one source or one common first turn) come together in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def turns_by(table: DataFrame, pair_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``(pair, turns)``: an array of (role, text) structs in order."""
    row = F.struct(F.col(f"`{turn_col}`").alias("turn"),
                   F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("user")).alias("role"),
                   F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return (table.select(F.col(f"`{pair_col}`").alias("pair"), row.alias("t")).where("pair is not null")
            .groupBy("pair").agg(F.sort_array(F.collect_list("t")).alias("ts"))
            .select("pair", F.transform("ts", lambda t: F.struct(t["role"].alias("role"),
                                                                 t["text"].alias("text"))).alias("turns")))


def common_turns(chosen: Column, rejected: Column) -> Column:
    """How many leading turns two conversations share."""
    same = F.zip_with(chosen, rejected, lambda a, b: a.eqNullSafe(b))
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def render(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(
        F.lit(OPEN), _plain(t["role"]), F.lit("\n"), _plain(t["text"]), F.lit(CLOSE + "\n"))))


def loss_spans(turns: Column) -> Column:
    """``array<struct<start, stop>>``: the assistant's texts and end marks in ``render(turns)``."""
    # A turn's fixed parts, and where its text starts.
    head = lambda t: F.length(_plain(t["role"])) + F.lit(len(OPEN) + 1)
    body = lambda t: F.length(_plain(t["text"])) + F.lit(len(CLOSE))     # noqa: E731
    none = F.array().cast("array<struct<start: int, stop: int>>")

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + head(t)
        stop = start + body(t)
        span = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        return F.struct((stop + 1).alias("at"), F.when(t["role"] == ASSISTANT, F.concat(state["spans"], span))
                        .otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda s: s["spans"])


def pair_columns(chosen: Column, rejected: Column) -> list[Column]:
    """The formatted pair from two arrays of (role, text) structs."""
    shared = common_turns(chosen, rejected)
    rest = lambda c: F.slice(c, shared + 1, F.size(c))
    return [shared.alias("n_prompt_turns"), render(F.slice(chosen, F.lit(1), shared)).alias("prompt"),
            render(rest(chosen)).alias("chosen"), render(rest(rejected)).alias("rejected"),
            loss_spans(rest(chosen)).alias("chosen_mask"), loss_spans(rest(rejected)).alias("rejected_mask")]


def format_preferences(chosen: DataFrame, rejected: DataFrame, pair_col: str = "conv_id", turn_col: str = "turn",
                       role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per pair id of either table of turns."""
    a = turns_by(chosen, pair_col, turn_col, role_col, text_col).withColumnRenamed("turns", "a")
    b = turns_by(rejected, pair_col, turn_col, role_col, text_col).withColumnRenamed("turns", "b")
    both = a.join(b, "pair", "full").select(
        "pair", *(F.coalesce(c, F.array().cast("array<struct<role: string, text: string>>")).alias(c) for c in "ab"))
    return both.select(F.col("pair").alias(pair_col), *pair_columns(F.col("a"), F.col("b")))

