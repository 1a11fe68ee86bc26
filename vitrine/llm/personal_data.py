"""Personal data: patterns of fixed kinds, and identifiers found by bootstrapped contexts; DataFrame expressions only.

The fixed kinds (and long hexadecimal secrets) are the seeds. Other runs of letters, digits and ``_.%+@-`` with a digit or an at sign, of at
least ``LEAST`` characters, are the identifiers that contexts may find. What stands around a seed or an identifier gives lexical patterns:
the two words in front, the word in front, the words on both sides, the two words behind (each with all signs in between, digits as
0, and the class of the value: with an at sign, with letters, or neither), and the shapes of both words and of a value with a sign inside.
Patterns and the distinct values that they stand around form a graph. A pattern scores, for each kind, the sum of the trust of its values over their number; a seed is
trusted as its kind, another value by the patterns that are good for a kind (noisy-or of their scores). A pattern is good for a kind
with a sum of at least ``SUPPORT`` and a score of at least ``SHARE`` (``GENERAL_SHARE`` for one word in front and for shapes). Rounds go on until no pattern becomes good; scores only rise, so this ends.
An identifier takes the kind of its best pattern (ties: the kind named first in ``ORDER``).

Scale: one scan cuts each text at its matches, and only narrow rows (numbers and hashes) leave it. Scores are sums over distinct
(pattern, value) pairs, combined before each shuffle; a very common pattern is one row after that. Patterns that stand around fewer than ``SUPPORT``
values, or around seeds only, change nothing and go before the rounds. Rounds are written to the shared folder; the driver sees counts only.

Expressions never look at a character more often than a match needs: runs are matched possessively, and a match can't start inside
a run unless the last match ended there, so long texts take time in proportion. Contexts have no limit of length.

Defined cases: a null text is empty; repeated rows are scanned one by one, and count once as values; spans count code points, end exclusive; an
identifier that touches a seed is none; columns other than the id and text are left out of the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: The kinds of the base rule in their order; equal to the plain patterns, but linear in time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
SECRET = r"(?<![0-9A-Za-z])[0-9a-f]{32,64}+(?![0-9A-Za-z])"
#: Runs with a digit or an at sign that may be identifiers; signs at their end are left out.
OTHER = r"(?<![A-Za-z0-9_.%+@-])(?=[A-Za-z_.%+-]*+[0-9@])[A-Za-z0-9_.%+@-]++"
LEAST, END_SIGNS = 4, ".%+-"
#: Words of contexts, and what stands between them, as Java patterns.
WORD, GLUE = r"[\p{L}\p{M}\p{N}_]", r"[^\p{L}\p{M}\p{N}_]"
#: What is looked at first for the two words next to a match; all of it where they don't end there.
_NEAR = 256
KINDS = ("email", "ip", "card", "phone")
ORDER = (*KINDS, "secret")
SUPPORT, SHARE, GENERAL_SHARE = 5, 0.8, 0.9
#: More good patterns, or spans to mask, than this are joined by a shuffle.
MOST_GOOD = 500_000
#: Masking cuts texts into blocks of two to this power code points.
_BLOCK = 11
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP_PARTS = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"


def _luhn(digits: Column) -> Column:
    """Checksum of a string of digits, the last one not doubled."""
    n = F.length(digits)
    value = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int")
    doubled = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i % 2 == 0, value(i)).when(value(i) > 4, value(i) * 2 - 9).otherwise(value(i) * 2))
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    return F.when(kind == "ip", value.rlike(IP_PARTS)).when(kind == "card", F.when(n.between(16, 19), _luhn(digits)).otherwise(False)).when(kind == "phone", n.between(8, 15)).when(kind == "other", F.length(value) >= LEAST).otherwise(True)


def _neighbours(text: Column) -> list[Column]:
    """The first word and the first two words of a text with all signs before and between them; empty without."""
    one, two = f"^({GLUE}*+{WORD}++)", f"^({GLUE}*+{WORD}++{GLUE}++{WORD}++)"
    near = F.substring(text, 1, _NEAR)
    source = F.when(near.rlike(two + GLUE), near).otherwise(text)
    return [F.regexp_extract(source, p, 1) for p in (one, two)]


def _plain(context: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(context), "[0-9]+", "0"), r"\s+", " ")


def _shape(value: Column) -> Column:
    """Runs of capitals, other letters and digits as A, a and 0."""
    marked = F.regexp_replace(F.regexp_replace(value, r"\p{Lu}+", "A"), r"[\p{L}\p{M}&&[^A]]+", "a")
    return F.regexp_replace(F.regexp_replace(marked, "[0-9]+", "0"), r"\s+", " ")


def _patterns(value: Column, left: Column, right: Column) -> Column:
    """Hashes of all patterns of a match, odd for general ones; ``left`` is what stands before it, backwards, ``right`` what follows."""
    l1, l2 = [F.reverse(x) for x in _neighbours(left)]
    r1, r2 = _neighbours(right)
    sort = F.when(F.contains(value, F.lit("@")), "@").when(value.rlike("[A-Za-z]"), "x").otherwise("9")
    both, shape = (l1 != "") & (r1 != ""), _shape(value)
    narrow = lambda *x: F.xxhash64(*x).bitwiseAND(F.lit(-2))
    general = lambda *x: F.xxhash64(*x).bitwiseOR(F.lit(1))
    return F.array_compact(F.array(
        F.when(l2 != "", narrow(F.lit("two before"), _plain(l2), sort)),
        F.when(l1 != "", general(F.lit("before"), _plain(l1), sort)),
        F.when(both, narrow(F.lit("around"), _plain(l1), _plain(r1), sort)),
        F.when(r2 != "", narrow(F.lit("two behind"), _plain(r2), sort)),
        F.when(both & shape.rlike("[^Aa0]"), general(F.lit("shapes"), _shape(l1), _shape(r1), shape)),
    ))


def _matches(text: Column, kind: str, pattern: str, guard: Column) -> Column:
    """Matches of one pattern with the text around each: (kind, number, length before, length, value, left, right). A match
    has a word, so two words are found no farther than behind the second next match."""
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def row(z: Column, v: Column, i: Column) -> Column:
        at = lambda a, k: F.coalesce(F.get(z[a], i + k), F.lit(""))
        value = F.rtrim(v, F.lit(END_SIGNS)) if kind == "other" else v
        left = F.concat(at("p", -2), at("f", -2), at("p", -1), at("f", -1), at("p", 0))
        cut_off = F.substring(v, F.length(value) + 1, F.length(v)) if kind == "other" else F.lit("")
        right = F.concat(cut_off, at("p", 1), at("f", 1), at("p", 2), at("f", 2), at("p", 3))
        return F.struct(F.lit(kind).alias("kind"), i.alias("number"), F.length(at("p", 0)).cast("long").alias("skipped"), F.length(v).cast("long").alias("size"), value.alias("value"), left.alias("left"), right.alias("right"))

    # A variable of a lambda function is computed once.
    once = F.transform(F.array(F.struct(parts.alias("p"), found.alias("f"))), lambda z: F.transform(z["f"], lambda v, i: row(z, v, i)))
    return F.when(guard, F.element_at(once, 1))


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Narrow rows of all matches, and at least one row for each document: row, doc_id, h, kind (null: none), start, end, patterns, value (hashes)."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("h"), t.alias("text"))
    body, at, digit = F.col("text"), F.contains(F.col("text"), F.lit("@")), F.col("text").rlike("[0-9]")
    found = [_matches(body, "email", EMAIL, at), _matches(body, "ip", IP, digit), _matches(body, "card", CARD, digit), _matches(body, "phone", PHONE, digit & F.contains(body, F.lit("+"))), _matches(body, "secret", SECRET, digit), _matches(body, "other", OTHER, at | digit)]
    # An array for each guard: nulls (no match is possible) are dropped before the arrays are joined.
    every = F.flatten(F.filter(F.array(*found), lambda a: a.isNotNull()))
    rows = texts.select("row", "doc_id", "h", F.explode_outer(every).alias("m")).select("row", "doc_id", "h", "m.*")
    kind = F.when(_valid(F.col("kind"), F.col("value")), F.col("kind"))
    known = rows.withColumn("own", kind)
    narrow = known.select("row", "doc_id", "h", "kind", "own", "number", "skipped", "size", F.length("value").cast("long").alias("length"), F.when(F.col("own").isNotNull(), F.xxhash64("value")).alias("value"), F.when(F.col("own").isNotNull(), _patterns(F.col("value"), F.reverse("left"), F.col("right"))).alias("patterns"))
    sums = Window.partitionBy("row", "kind").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    placed = narrow.repartition("row").withColumn("from", F.sum(F.col("skipped") + F.col("size")).over(sums) - F.col("size")).where(F.col("own").isNotNull() | F.col("kind").isNull() | (F.col("number") == 0))
    return placed.select("row", "doc_id", "h", F.col("own").alias("kind"), F.col("from").alias("start"), (F.col("from") + F.col("length")).alias("end"), "patterns", "value")


def without_overlaps(rows: DataFrame) -> DataFrame:
    """Drops identifiers of no fixed kind that touch a seed of the same row: the furthest end of the seeds before, and the nearest start behind."""
    other = F.when(F.col("kind") == "other", 1).otherwise(0)
    before = Window.partitionBy("row").orderBy("start", other).rowsBetween(Window.unboundedPreceding, -1)
    # What is behind is read backwards: a frame that shrinks from its start would be summed up anew for every row.
    behind = Window.partitionBy("row").orderBy(F.desc("start"), other.desc()).rowsBetween(Window.unboundedPreceding, -1)
    seed = F.col("kind") != "other"
    touched = (F.coalesce(F.max(F.when(seed, F.col("end"))).over(before), F.lit(-1)) > F.col("start")) | (F.coalesce(F.min(F.when(seed, F.col("start"))).over(behind), F.lit(1 << 60)) < F.col("end"))
    # A document whose only rows are such identifiers keeps a row of no kind.
    dropped = (F.col("kind") == "other") & F.col("touched")
    return rows.withColumn("touched", touched).withColumn("kind", F.when(dropped, F.lit(None)).otherwise(F.col("kind"))).drop("touched")


def score_patterns(rows: DataFrame, support: int = SUPPORT, share: float = SHARE, general_share: float = GENERAL_SHARE) -> DataFrame:
    """(pattern, found, p) of good patterns: the kind that they stand for, and their score."""
    pairs = rows.where("kind is not null").select(F.explode("patterns").alias("pattern"), "value", F.when(F.col("kind") != "other", F.col("kind")).alias("seed"))
    edges = pairs.groupBy("pattern", "value").agg(F.min("seed").alias("seed"))
    sums = edges.groupBy("pattern").agg(F.count("*").alias("n"), F.count("seed").alias("seeds"), *[F.count(F.when(F.col("seed") == k, 1)).alias(k) for k in ORDER])
    useful = cut(sums.where((F.col("n") >= support) & (F.col("seeds") < F.col("n"))))
    open_ = cut(edges.where("seed is null").select("pattern", "value").join(useful.select("pattern"), "pattern", "left_semi"))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("found"), F.col(k).cast("double").alias("s")) for k in ORDER]))
    first = useful.select("pattern", "n", kinds.alias("k")).select("pattern", "n", "k.found", "k.s")

    def good(scored: DataFrame) -> DataFrame:
        p = F.round(F.col("s") / F.col("n"), 9)
        least = F.when(F.col("pattern").bitwiseAND(F.lit(1)) == 1, general_share).otherwise(share)
        return cut(scored.select("pattern", "found", p.alias("p")).where((F.round("s", 9) >= support) & (p >= least)))

    now = good(first)
    size = now.count()
    while size:
        side = F.broadcast(now) if size <= MOST_GOOD else now
        doubt = F.sum(F.log(F.greatest(1 - F.col("p"), F.lit(1e-6))))
        trust = cut(open_.join(side, "pattern").groupBy("value", "found").agg((1 - F.exp(doubt)).alias("trust")))
        more = open_.join(trust, "value").groupBy("pattern", "found").agg(F.sum("trust").alias("more"))
        now = good(first.join(more, ["pattern", "found"], "left").withColumn("s", F.col("s") + F.coalesce("more", F.lit(0.0))))
        before, size = size, now.count()
        if size == before:
            break
    return now


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row for each document: doc_id, h (hash of the text), ``base`` and ``spans``, arrays of (rank, kind, start, end) in order."""
    rows = cut(without_overlaps(occurrences(docs, doc_id, text)))
    good = score_patterns(rows, **options)
    side = F.broadcast(good) if good.count() <= MOST_GOOD else good
    rank = lambda c: F.coalesce(*[F.when(F.col(c) == k, i) for i, k in enumerate(ORDER)])
    others = rows.where("kind = 'other'").select("row", "doc_id", "h", "start", "end", F.explode("patterns").alias("pattern")).join(side, "pattern")
    best = others.groupBy("row", "doc_id", "h", "start", "end").agg(F.max_by("found", F.struct("p", -rank("found"))).alias("kind"))
    found = best.select("row", "doc_id", "h", "kind", "start", "end", F.lit(False).alias("base"))
    own = F.when(F.col("kind") != "other", F.col("kind"))
    seeds = rows.select("row", "doc_id", "h", own.alias("kind"), "start", "end", F.coalesce(F.col("kind").isin(*KINDS), F.lit(False)).alias("base"))
    span = F.struct(rank("kind").alias("rank"), "kind", "start", "end")
    known = F.col("kind").isNotNull()
    out = seeds.unionByName(found).groupBy("row", "doc_id", "h").agg(F.sort_array(F.collect_set(F.when(known & F.col("base"), span))).alias("base"), F.sort_array(F.collect_set(F.when(known, span))).alias("spans"))
    return out.drop("row")


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, runs: Column, end: Column) -> Column:
    """The text with each run replaced by its kind in angle brackets; ``runs`` has what stands free before each (from, start, kind), and
    the text goes on at ``end``. The text is cut into blocks once, so no run looks at it from its beginning."""
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << _BLOCK}}}"), F.lit(0))

    def piece(b: Column, first: Column, until: Column) -> Column:
        at = F.shiftright(first, _BLOCK).cast("int")
        near = F.slice(b, at + 1, F.greatest(F.shiftright(until, _BLOCK).cast("int") - at, F.lit(0)) + 1)
        return F.substring(F.array_join(near, ""), first.bitwiseAND((1 << _BLOCK) - 1).cast("int") + 1, (until - first).cast("int"))

    def whole(b: Column) -> Column:
        parts = F.transform(runs, lambda s: F.concat(piece(b, s["from"], s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        return F.concat(F.array_join(parts, ""), piece(b, end, F.length(text).cast("long")))

    # A variable of a lambda function is computed once.
    return F.element_at(F.transform(F.array(blocks), whole), 1)


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All documents with their spans masked (overlapping spans as one, by the kind of the first).

    Spans come back by doc id and text hash: broadcast while they are few, else texts with a digit or an at sign are shuffled; others, which can't have
    a span, never are. Any column names may stand in ``docs``.
    """
    found = find_personal_data(docs, doc_id, text, **options).where(F.size("spans") > 0)
    once = found.groupBy("doc_id", "h").agg(F.first("spans").alias("spans"))
    span = once.select("doc_id", "h", F.explode("spans").alias("s")).select("doc_id", "h", "s.*")
    before = Window.partitionBy("doc_id", "h").orderBy("start", "end", "rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = span.withColumn("from", F.coalesce(F.max("end").over(before), F.lit(0).cast("long")))
    run = F.when(F.col("start") >= F.col("from"), F.struct("start", "from", "kind"))
    runs = cut(placed.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list(run)).alias("runs"), F.max("end").alias("end")))
    few = (runs.agg(F.sum(F.size("runs"))).first()[0] or 0) <= MOST_GOOD
    # The row travels as one struct, so no name can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("body", F.col("row")[text].cast("string"))
    may = F.coalesce(F.col("body").rlike("[0-9@]"), F.lit(False))
    hit = rows.where(may).join(F.broadcast(runs) if few else runs, F.col("row")[doc_id].eqNullSafe(F.col("doc_id")) & (F.xxhash64("body") == F.col("h")), "left")
    new = F.when(F.col("runs").isNotNull(), masked(F.col("body"), F.col("runs"), F.col("end"))).otherwise(F.col("body"))
    clean = rows.where(~may).select("row", "body").unionByName(hit.select("row", new.alias("body")))
    return clean.select(*[F.col("body").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
