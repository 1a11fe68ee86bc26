"""Chat formatting in windows of a token budget, in DataFrame functions only.

A conversation is cut into spans of whole turns. Which span a turn belongs to is told by the prefix sum of its tokens alone, so no task walks through a
conversation: turns are numbered by a sort of the whole table, sums run within blocks of turns, and blocks are shifted by what lies before them. Every
span gets the conversation's system turn and some of the turns before it again; what is repeated is never under the loss mask.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, hot_keys, join_hot
from .conversations import block, in_order

#: Control strings of the template.
START, END, LINE = "<|im_start|>", "<|im_end|>", "<|lf|>"


def escape(text: Column) -> Column:
    """No ``<|`` is left in the text: a backslash goes in, behind those that are there already."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escape_role(role: Column) -> Column:
    """As texts; a line feed would end the role and gets a control string of its own."""
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(LINE), F.lit("\n")))


@dataclass(frozen=True)
class Budget:
    """Tokens of a window; tokens and number of the turns before a span that are repeated in front of it; a system turn of up to ``system`` tokens is
    repeated in every window, a longer one stands in the first only."""

    window: int = 2048
    history: int = 256
    history_turns: int = 4
    system: int = 256

    def __post_init__(self):
        if min(self.window, self.history, self.history_turns, self.system) < 0 or self.window - self.history - self.system < 2:
            raise ValueError("history and system turn leave no room in the window")


def estimated_tokens(turn: str = "turn_text") -> Column:
    """Tokens of a formatted turn: a quarter of its bytes, rounded up."""
    return F.ceil(F.octet_length(turn) / 4).cast("bigint")


def windows(df: DataFrame, budget: Budget = Budget(), tokens: Column | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each window: ``conv, window, turns, repeated, tokens, over_budget, formatted, loss``.

    ``formatted`` holds ``<|im_start|>role``, a line feed, the text and ``<|im_end|>`` with a line feed for each turn: the system turn, the repeated
    turns, and then the window's own. The first ``repeated`` turns stand in an earlier window too. ``turns`` counts the own ones, ``window`` rises
    along the conversation. ``loss`` lists (start, end) in code points of ``formatted``: the texts of the window's own assistant turns. Each turn of
    the table is some window's own once.

    ``tokens`` counts those of a formatted turn, the column ``turn_text`` (by default :func:`estimated_tokens`). A window keeps to the budget unless
    one of its own turns is longer than the room that system turn and history leave; such a turn has a window of its own, marked ``over_budget`` if
    the whole is longer than the budget.

    Null roles and texts are empty, rows without an id are one conversation, null turns come first, ties go by role and text (their MD5), and turns that
    repeat are turns. An empty table gives no rows. Extra columns are ignored.
    """
    ordered = in_order(df, conv, turn, role, text)
    texts = ordered.select("__key", "conv", "__place", F.col("role"), escape_role(F.col("role")).alias("__role"), escape(F.col("text")).alias("__text"))
    formatted = F.concat(F.lit(START), F.col("__role"), F.lit("\n"), F.col("__text"), F.lit(END + "\n")).alias("turn_text")
    counted = F.greatest(estimated_tokens() if tokens is None else tokens, F.lit(1)).cast("bigint")
    narrow = texts.select("__key", "__place", "role", formatted).select("__key", "__place", block().alias("__block"), (F.col("role") == "system").alias("__system"), counted.alias("__tokens"))
    placed = cut(_prefix_sums(narrow, budget))

    own = placed.where("not __head").withColumn("__room", budget.window - F.col("__head_tokens") - budget.history)
    # Ordinary turns take half of the room at most. A span is as wide as the room without the longest of them, so one that reaches into a span from before
    # never makes it longer than the room; a longer turn that does is a span for itself.
    width = F.col("__room") - F.col("__longest")
    cell = F.floor((F.col("__sum") - 1) / width)
    alone = (F.col("__tokens") * 2 > F.col("__room")) & (F.col("__sum") - F.col("__tokens") <= cell * width)
    own = own.withColumns({"__cell": cell, "__nth": F.when(alone, 0).otherwise(1)})
    left = budget.window - F.max("__head_tokens") - F.sum("__tokens")
    spans = cut(own.groupBy("__key", "__cell", "__nth").agg(
        F.min("__number").alias("window"), F.min(F.col("__sum") - F.col("__tokens")).alias("__before"), F.least(left, F.lit(budget.history)).alias("__left"),
    ))

    # Each window's own turns, some of those before it, and the system turn.
    members = own.select("__place", F.min("__number").over(Window.partitionBy("__key", "__cell", "__nth")).alias("window"), F.lit(2).alias("kind"), "__tokens")
    if budget.history_turns:
        asked = spans.where("window > 0").select("__key", "window", "__before", "__left", F.explode(F.sequence(F.col("window") - 1, F.greatest(F.col("window") - budget.history_turns, F.lit(0)))).alias("__number"))
        again = asked.join(own.select("__key", "__number", "__place", "__tokens", "__sum"), ["__key", "__number"])
        again = again.where(F.col("__before") - (F.col("__sum") - F.col("__tokens")) <= F.col("__left"))
        members = members.unionByName(again.select("__place", "window", F.lit(1).alias("kind"), "__tokens"))
    parts = members.join(texts, "__place")
    # A conversation's system turn is short here, so those of the few with very many windows are broadcast.
    heads = placed.where("__head").select("__place", "__tokens").join(texts.where("role = 'system'"), "__place")
    led = join_hot(spans.select("__key", "window"), heads, "__key", hot_keys(spans, "__key"))
    parts = parts.unionByName(led.withColumn("kind", F.when(F.col("window") == 0, 2).otherwise(0)))
    piece = F.struct("kind", F.col("__place").alias("place"), F.col("__role").alias("role"), F.col("__text").alias("text"), (F.col("role") == "assistant").alias("told"), F.col("__tokens").alias("tokens"))
    return _assembled(parts.groupBy("__key", "conv", "window").agg(F.array_sort(F.collect_list(piece)).alias("__pieces")), budget)


def _prefix_sums(turns: DataFrame, budget: Budget) -> DataFrame:
    """Adds ``__number`` (of the turn in its conversation, without the head), ``__sum`` (of tokens up to it, without the head's), ``__head`` (whether
    it is a system turn that is repeated), ``__head_tokens`` and ``__longest`` (tokens of the conversation's longest ordinary turn).

    A task meets one row for each block of a conversation, some thousandth of its turns."""
    at = Window.partitionBy("__key", "__block").orderBy("__place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = turns.withColumns({"__s": F.sum("__tokens").over(at), "__n": F.count("*").over(at)})
    lead = F.struct("__place", "__system", "__tokens")
    blocks = turns.groupBy("__key", "__block").agg(F.sum("__tokens").alias("s"), F.count("*").alias("n"), F.min(lead).alias("lead"))
    before = Window.partitionBy("__key").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("__key")
    shifted = blocks.select(
        "__key", "__block", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("__s0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__n0"),
        F.min("lead").over(whole).alias("lead"), F.sum("n").over(whole).alias("__turns"),
    )
    # A system turn that has a turn behind it and is short enough leads every window.
    leads = F.col("lead.__system") & (F.col("__turns") > 1) & (F.col("lead.__tokens") <= budget.system)
    shifted = shifted.select("__key", "__block", "__s0", "__n0", F.when(leads, F.col("lead.__place")).alias("__lead"), F.when(leads, F.col("lead.__tokens")).otherwise(0).alias("__head_tokens"))
    rows = local.join(shifted, ["__key", "__block"])
    heads = F.col("__lead").isNotNull().cast("int")
    rows = rows.select(
        "__key", "__place", "__block", "__tokens", F.coalesce(F.col("__place") == F.col("__lead"), F.lit(False)).alias("__head"), "__head_tokens",
        (F.col("__s") + F.col("__s0") - F.col("__head_tokens")).alias("__sum"), (F.col("__n") + F.col("__n0") - 1 - heads).alias("__number"),
    )
    room = budget.window - F.col("__head_tokens") - budget.history
    ordinary = F.when(~F.col("__head") & (F.col("__tokens") * 2 <= room), F.col("__tokens")).otherwise(0)
    longest = rows.groupBy("__key", "__block").agg(F.max(ordinary).alias("m")).select("__key", "__block", F.max("m").over(whole).alias("__longest"))
    return rows.join(longest, ["__key", "__block"])


def _assembled(grouped: DataFrame, budget: Budget) -> DataFrame:
    """Joins the pieces of each window and tells where its loss lies."""
    whole = lambda p: F.concat(F.lit(START), p["role"], F.lit("\n"), p["text"], F.lit(END + "\n"))
    rows = grouped.withColumn("__texts", F.transform("__pieces", whole))
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.length(p["role"]) + (len(START) + 1)
        end = begin + F.length(p["text"])
        mine = (p["kind"] == 2) & p["told"]
        span = F.array(F.struct(begin.cast("bigint").alias("start"), end.cast("bigint").alias("end")))
        return F.struct((end + len(END) + 1).cast("bigint").alias("at"), F.when(mine, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    loss = F.aggregate("__pieces", zero, step, lambda acc: acc["spans"])
    tokens = F.aggregate("__pieces", F.lit(0).cast("bigint"), lambda acc, p: acc + p["tokens"])
    own = F.size(F.filter("__pieces", lambda p: p["kind"] == 2))
    return rows.select(
        "conv", "window", own.cast("bigint").alias("turns"), (F.size("__pieces") - own).cast("bigint").alias("repeated"), tokens.alias("tokens"),
        (tokens > budget.window).alias("over_budget"), F.array_join("__texts", "").alias("formatted"), loss.alias("loss"),
    )


def own_turns() -> Column:
    """Roles and texts of a window's own turns, read back from ``formatted``: ``array<struct<role, text>>``."""
    turns = F.split("formatted", r"<\|im_end\|>\n")
    begin = len(START)
    parsed = F.transform(
        F.slice(turns, F.col("repeated").cast("int") + 1, F.col("turns").cast("int")),
        lambda t: F.struct(
            unescape_role(F.substring_index(F.substring(t, begin + 1, 2**31 - 1), "\n", 1)).alias("role"),
            unescape(F.substring(t, F.locate("\n", t) + 1, F.length(t))).alias("text"),
        ),
    )
    return parsed


def loss_texts() -> Column:
    """What lies under the loss mask, span by span, as it was before it was escaped."""
    return F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
