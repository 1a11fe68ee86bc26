"""Repair of conversations by a min-plus matrix scan.

The roles of a sound conversation are ``(s?(ua)+)?``. Read from left to right there are four states: nothing yet, behind the system turn, behind a
user turn, behind an assistant turn; the first and the last may end it. A turn is a 4x4 matrix: entry (i, j) is the cheapest way (cost, edits) to get
from state i to state j by inserting turns, as many as wanted, and then keeping, renaming or deleting the turn. Products of such matrices add costs
and join edits; sums take the smaller (cost, edits). That is associative, so the turns of a conversation are multiplied in blocks, and the blocks in a
tree, whatever the number of partitions that they lie in. Cheapest edits go down the same tree to the turns.

Between two states, over the same turns, equally cheap edits are never a prefix of one another (what one has more could only be insertions, which
cost), so joining the same edits to both never turns their order around.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import conversations
from .common import cut, scan
from .conversations import block, in_order

#: Costs of edits, and of a truncated turn that stays.
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Edits as stored, in the order of the letters that they stand for: Delete, Insert (assistant, user), Keep, Rerole (to assistant, to user).
EDITS, LETTERS = "DIJKRS", "DIIKRR"
#: Blanks of texts: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
#: At most so many blocks are multiplied by one call.
FAN_BITS = 6
#: Kinds of turns: initial (s, u, a, other) * 4 + fault (none, blank, duplicate, truncated); FIRST marks the first turn of its role and text.
INITIALS, NONE, BLANK, DUPLICATE, CUT, FIRST = "sua", 0, 1, 2, 3, -1

Entry = tuple[int, str]
Matrix = list[list[Entry | None]]

#: State behind a role, by the state before it: nothing, system, user, assistant.
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}


def product(a: Matrix, b: Matrix) -> Matrix:
    """Costs add up, edits are joined, the smaller (cost, edits) wins."""
    out: Matrix = []
    for row in a:
        best: list[Entry | None] = [None] * 4
        for k, x in enumerate(row):
            if x is not None:
                for j, y in enumerate(b[k]):
                    if y is not None and (best[j] is None or x[0] + y[0] <= best[j][0]):
                        new = (x[0] + y[0], x[1] + y[1])
                        if best[j] is None or new < best[j]:
                            best[j] = new
        out.append(best)
    return out


def empty() -> Matrix:
    return [[(0, "") if i == j else None for j in range(4)] for i in range(4)]


@cache
def closure() -> Matrix:
    """Any number of insertions: there are four states, so three of them reach whatever can be reached."""
    once = empty()
    for role, edit in (("u", "J"), ("a", "I")):
        for i, j in NEXT[role].items():
            once[i][j] = (INSERT, edit)
    return product(once, product(once, once))


@cache
def turn_matrix(kind: int) -> Matrix:
    """Insertions, then one edit of a turn of this kind."""
    initial, fault = kind >> 2, kind & 3
    edits: Matrix = [[None] * 4 for _ in range(4)]
    for i in range(4):
        edits[i][i] = (DELETE, "D")
    if fault in (NONE, CUT):
        more = TRUNCATED if fault == CUT else 0
        for role, edit in (("u", "S"), ("a", "R")):
            for i, j in NEXT[role].items():
                edits[i][j] = (RENAME + more, edit)
        for i, j in NEXT[INITIALS[initial]].items() if initial < 3 else ():
            edits[i][j] = (more, "K")
    return product(closure(), edits)


#: What is known of some turns in a row: their number, faults and illegal neighbours, first and last initial, and their matrix row by row.
SUMMARY = "turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first int, last int, costs array<bigint>, edits array<string>"


def legal(a: int, b: int) -> bool:
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def pack(matrix: Matrix) -> tuple[list[int], list[str]]:
    flat = [e or (-1, "") for row in matrix for e in row]
    return [e[0] for e in flat], [e[1] for e in flat]


def unpack(costs: list[int], edits: list[str]) -> Matrix:
    flat = [None if c < 0 else (c, e) for c, e in zip(costs, edits)]
    return [flat[i : i + 4] for i in range(0, 16, 4)]


def kinds_of(places: Iterable[dict]) -> list[tuple[int, int]]:
    """(place, kind) in order: turns that are not blank and not the first of their kind are duplicates."""
    firsts, turns = set(), []
    for p in places:
        firsts.add(p["place"]) if p["kind"] == FIRST else turns.append((p["place"], p["kind"]))
    return [(at, k & ~3 | DUPLICATE if k & 3 in (NONE, CUT) and at not in firsts else k) for at, k in sorted(turns)]


def summarise(places: list[dict]) -> tuple:
    """Summary of a block's turns."""
    kinds = [k for _, k in kinds_of(places)]
    faults = [k & 3 for k in kinds]
    out = empty()
    for k in kinds:
        out = product(out, turn_matrix(k))
    illegal = sum(not legal(a >> 2, b >> 2) for a, b in zip(kinds, kinds[1:]))
    return (len(kinds), faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, kinds[0] >> 2, kinds[-1] >> 2, *pack(out))


def join_summaries(parts: list[dict]) -> tuple:
    """Summary of blocks in order; matrices are multiplied in pairs, so that edits are joined a few times only."""
    parts = sorted(parts, key=lambda p: p["at"])
    matrices = [unpack(p["costs"], p["edits"]) for p in parts]
    while len(matrices) > 1:
        matrices = [product(*matrices[i : i + 2]) if i + 1 < len(matrices) else matrices[i] for i in range(0, len(matrices), 2)]
    sums = [sum(p[c] for p in parts) for c in ("turns", "blank", "duplicate", "truncated", "illegal")]
    sums[-1] += sum(not legal(a["last"], b["first"]) for a, b in zip(parts, parts[1:]))
    return (*sums, parts[0]["first"], parts[-1]["last"], *pack(matrices[0]))


def columns(rows: list[tuple], names: str) -> list[list]:
    n = names.count(",") + 1
    return [list(c) for c in zip(*rows)] if rows else [[]] * n


def each(function):
    """For :func:`common.scan`: the function over each list of the one column."""

    def make():
        return lambda column: columns([function(v) for v in column.to_pylist()], SUMMARY)

    return make


def damage(df: DataFrame) -> DataFrame:
    """Conversations with faults, told by the CRC-32 of ``conv_id:turn`` modulo 20 (nulls: one space): 0 drops the row, 1 empties its text, 2 takes its
    full stops, exclamation and question marks, 3 repeats it, 4 makes it a user's. For tests, and for the query."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = df.select("conv_id", "turn", text("role").alias("__r"), text("text").alias("__t"), hit.alias("__hit")).where("__hit <> 0")
    out = F.when(F.col("__hit") == 1, "").when(F.col("__hit") == 2, F.regexp_replace("__t", "[.!?]", "")).otherwise(F.col("__t"))
    rows = rows.select("conv_id", "turn", F.when(F.col("__hit") == 4, "user").otherwise(F.col("__r")).alias("role"), out.alias("text"), F.array_repeat(F.lit(0), F.when(F.col("__hit") == 3, 2).otherwise(1)).alias("__times"))
    return rows.select("conv_id", "turn", "role", "text", F.explode("__times").alias("__i")).drop("__i")


def turn_kind() -> Column:
    """Initial and fault of a turn, without duplicates, which other turns tell."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(trimmed == "", BLANK).when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(NONE)
    initial = F.substring("role", 1, 1)
    return F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3) * 4 + fault


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(summaries, repaired turns) by the cheapest edits.

    Summaries, one for each conversation: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``. ``audit`` has a letter for each edit
    (Keep, Rerole, Delete, Insert), the least of the cheapest ones. Repaired turns: ``conv, place, nth, role, text, edit``, in the order of
    ``place, nth``. A turn's first fault counts: blank, a repetition of an earlier role and text, truncated (no ``.!?`` at the end).

    Turns are ordered by ``turn`` (nulls first), ties by role and text (their MD5). Null roles and texts are empty; an empty or unknown role can't be
    kept. Rows without a conversation id are one conversation. A conversation whose turns all go has no repaired turns; an empty table gives no rows.
    Extra columns are ignored.
    """
    ordered = in_order(df, conv, turn, role, text)
    # The digest of role and text; the role's length keeps them apart.
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    kind = turn_kind()
    turns = ordered.select("__key", "__place", kind.alias("kind"), same.alias("same"))
    firsts = turns.where(F.col("kind").bitwiseAND(3) != BLANK).groupBy("__key", "same").agg(F.min("__place").alias("__place")).select("__key", "__place", F.lit(FIRST).alias("kind"))
    listed = F.collect_list(F.struct(F.col("__place").alias("place"), "kind")).alias("places")
    blocks = cut(turns.select("__key", "__place", "kind").unionByName(firsts).groupBy("__key", block().alias("at")).agg(listed))
    levels = [cut(scan(blocks, ["places"], SUMMARY, each(summarise), keep=["__key", "at"]))]
    bits = conversations.BLOCK_BITS

    def merged(parts: DataFrame, at: Column) -> DataFrame:
        grouped = parts.groupBy("__key", at.alias("__up")).agg(F.collect_list(F.struct(*[F.col(c) for c in parts.columns if c != "__key"])).alias("parts"))
        return scan(grouped.withColumnRenamed("__up", "at"), ["parts"], SUMMARY, each(join_summaries), keep=["__key", "at"])

    # Blocks are merged by some bits of their numbers at a time until few enough are left of each conversation.
    while bits < 63 and (levels[-1].groupBy("__key").count().agg(F.max("count")).first()[0] or 0) > 1 << FAN_BITS:
        bits += FAN_BITS
        levels.append(cut(merged(levels[-1], F.shiftright("at", FAN_BITS))))
    whole = cut(merged(levels[-1], F.lit(0).cast("bigint")))
    best = scan(whole, ["costs", "edits"], "cost bigint, code string", lambda: cheapest, keep=["__key", "blank", "duplicate", "truncated", "illegal"])
    best = cut(best)

    seen = ordered.groupBy("__key", "conv").agg(F.max("turn").alias("t"), F.min("turn").alias("f"))
    distinct = ordered.where("turn is not null").select("__key", "turn").distinct().groupBy("__key").agg(F.count("*").alias("d"))
    gaps = F.coalesce(F.col("t") - F.col("f") + 1 - F.col("d"), F.lit(0)).cast("bigint").alias("gaps")
    summaries = seen.join(distinct, "__key", "left").join(best, "__key").select("conv", gaps, "blank", "duplicate", "truncated", "illegal", "cost", F.translate("code", EDITS, LETTERS).alias("audit"))

    # Down again: each part of a conversation gets its own part of the edits.
    pieces = best.select("__key", F.lit(0).cast("bigint").alias("up"), F.col("code").alias("piece"))
    for i in reversed(range(len(levels))):
        up = F.lit(0).cast("bigint") if i == len(levels) - 1 else F.shiftright("at", FAN_BITS)
        children = levels[i].groupBy("__key", up.alias("up")).agg(F.array_sort(F.collect_list(F.struct("at", "turns"))).alias("children"))
        split = scan(children.join(pieces, ["__key", "up"]), ["children", "piece"], "parts array<struct<at:bigint,piece:string>>", lambda: hand_down, keep=["__key"])
        pieces = split.select("__key", F.explode("parts").alias("p")).select("__key", F.col("p.at").alias("up"), "p.piece")
    by_turn = scan(blocks.withColumnRenamed("at", "up").join(pieces, ["__key", "up"]), ["places", "piece"], "edits array<struct<place:bigint,edit:string>>", lambda: to_turns, keep=[])
    by_turn = by_turn.select(F.explode("edits").alias("e")).select(F.col("e.place").alias("__place"), "e.edit").where("edit <> 'D'")
    edits = ordered.join(by_turn, "__place").select("conv", F.col("__place").alias("place"), F.col("role").alias("__role"), F.col("text").alias("__text"), F.posexplode(F.split("edit", "")).alias("nth", "edit")).where("edit not in ('D', '')")
    new_role = F.when(F.col("edit").isin("J", "S"), "user").when(F.col("edit").isin("I", "R"), "assistant").otherwise(F.col("__role"))
    new_text = F.when(F.col("edit").isin("I", "J"), "").otherwise(F.col("__text"))
    return summaries, edits.select("conv", "place", "nth", new_role.alias("role"), new_text.alias("text"), F.translate("edit", EDITS, LETTERS).alias("edit"))


def cheapest(costs: pa.Array, edits: pa.Array) -> list[list]:
    """The least (cost, edits) that starts with nothing and ends with nothing or behind an assistant."""
    out = []
    for c, e in zip(costs.to_pylist(), edits.to_pylist()):
        row = product([unpack(c, e)[0]], closure())[0]
        out.append(min(x for x in (row[0], row[3]) if x is not None))
    return columns(out, "cost bigint, code string")


def cut_edits(code: str, sizes: list[int]) -> list[str]:
    """Pieces of the edits for so many turns each: insertions stand before the turn that follows them, the last ones behind the last turn."""
    out, at = [], 0
    for size in sizes:
        begin = at
        while size:
            size -= code[at] not in "IJ"
            at += 1
        out.append(code[begin:at])
    out[-1] += code[at:]
    return out


def hand_down(children: pa.Array, pieces: pa.Array) -> list[list]:
    return [[[{"at": c["at"], "piece": p} for c, p in zip(own, cut_edits(code, [c["turns"] for c in own]))] for own, code in zip(children.to_pylist(), pieces.to_pylist())]]


def to_turns(places: pa.Array, pieces: pa.Array) -> list[list]:
    """Edits of each turn, with the insertions before it."""
    out = []
    for own, code in zip(places.to_pylist(), pieces.to_pylist()):
        turns = sorted(p["place"] for p in own if p["kind"] != FIRST)
        out.append([{"place": at, "edit": e} for at, e in zip(turns, cut_edits(code, [1] * len(turns)))])
    return [out]
