"""What the operators on conversations share: their turns in order, each with a number that tells its place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Turns of a conversation that share the higher bits of ``__place`` form a block; a block has at most so many bits' worth of turns.
BLOCK_BITS = 10


def conversation_key(conv: str) -> Column:
    """A string for each conversation, never null: rows without an id are one conversation."""
    return F.when(F.col(conv).isNull(), "n").otherwise(F.concat(F.lit("c"), F.col(conv).cast("string")))


def in_order(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``__key, conv, turn, role, text, __place``: turns by conversation and turn (nulls first), ties by the MD5 of role and text.

    ``__place`` rises with the order and is unique. Rows are dealt out by ranges of the whole order, equal rows too, so a conversation of any length
    is spread over as many tasks as it needs. The rows are written once to the shared folder: places must not change when a task runs again.
    """
    tie = F.md5(F.concat(F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit(""))))
    rows = df.select(
        conversation_key(conv).alias("__key"), F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"), tie.alias("__tie"), F.monotonically_increasing_id().alias("__copy"),
    )
    order = [F.asc("__key"), F.asc_nulls_first("turn"), F.asc("__tie"), F.asc("__copy")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut(placed.select("__key", "conv", "turn", "role", "text", F.monotonically_increasing_id().alias("__place")))


def block() -> Column:
    return F.shiftright("__place", BLOCK_BITS)
