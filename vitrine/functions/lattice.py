"""Nouns of texts that don't part words from particles: the cheapest way through a lattice of dictionary words.

The dictionary is a DataFrame of the caller, (form, tag, cost), with an optional one of what it costs that two tags meet,
(left, right, cost); an empty tag is the edge of a run. Costs are whole numbers and may be negative. None comes with the library.
Texts are cut at blanks; each run between blanks is a lattice of its own.

Defined cases: rows with a null, or with an empty form or one with a blank, are no words; of repeated (form, tag) and (left, right)
rows the cheapest counts; of equally cheap ways that with the smaller tags from the end (the edge of a run is the smallest), then the longer words, is taken; a null or
blank text has no words; time and memory grow with the longest run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: By kind of characters: tag, cost and cost for each character of a word that is not in the dictionary.
UNKNOWN = {"hangul": ("NNG", 6000, 1500), "letter": ("SL", 3000, 0), "digit": ("SN", 2000, 0), "other": ("SW", 2000, 0)}
#: Unknown Hangul words are up to so long (a longer one is several), those of other kinds are the rest of their run.
LONGEST_UNKNOWN = 8


def kind_of(c: str) -> str:
    return "hangul" if "가" <= c <= "힣" else "letter" if c.isalpha() else "digit" if c.isdigit() else "other"


class Lexicon:
    def __init__(self, words: Iterable[tuple[str, str, int]], joins: Iterable[tuple[str, str, int]] = (), unknown: dict[str, tuple[str, int, int]] = UNKNOWN):
        self.words: dict[str, list[tuple[str, int]]] = {}
        #: Lengths of the words that start with a character.
        self.lengths: dict[str, set[int]] = {}
        for form, tag, cost in words:
            self.words.setdefault(form, []).append((tag, cost))
            self.lengths.setdefault(form[0], set()).add(len(form))
        self.joins = {(left, right): cost for left, right, cost in joins}
        self.unknown = unknown

    def edges(self, run: str) -> Iterator[tuple[int, int, str, int]]:
        """(start, end, tag, cost) of known and unknown words, by start."""
        kinds = [kind_of(c) for c in run]
        ends = [len(run)] * len(run)
        for i in range(len(run) - 2, -1, -1):
            ends[i] = ends[i + 1] if kinds[i] == kinds[i + 1] else i + 1
        for i, c in enumerate(run):
            for n in self.lengths.get(c, ()):
                for tag, cost in self.words.get(run[i : i + n], ()) if i + n <= len(run) else ():
                    yield i, i + n, tag, cost
            tag, cost, each = self.unknown[kinds[i]]
            for end in range(i + 1, min(ends[i], i + LONGEST_UNKNOWN) + 1) if kinds[i] == "hangul" else (ends[i],):
                yield i, end, tag, cost + each * (end - i)

    def path(self, run: str) -> tuple[int, list[tuple[str, str]]]:
        """Cost and (form, tag) of the cheapest way through one run."""
        # By end and tag of a word: the least cost up to there, its start and the tag in front.
        best: list[dict[str, tuple[int, int, str]]] = [{"": (0, 0, "")}, *({} for _ in run)]
        join = self.joins.get
        for start, end, tag, cost in self.edges(run):
            if best[start]:
                total, before = min((x[0] + join((t, tag), 0), t) for t, x in best[start].items())
                way, now = (total + cost, start, before), best[end].get(tag)
                if now is None or (way[0], before, start) < (now[0], now[2], now[1]):
                    best[end][tag] = way
        cost, tag = min((x[0] + join((t, ""), 0), t) for t, x in best[-1].items())
        end, out = len(run), []
        while end:
            _, start, before = best[end][tag]
            out.append((run[start:end], tag))
            end, tag = start, before
        return cost, out[::-1]

    def analyze(self, text: str) -> Iterator[tuple[str, str]]:
        for run in text.split():
            yield from self.path(run)[1]


def lattice_analyzer(words: DataFrame, joins: DataFrame | None = None, max_words: int = 1_000_000) -> Callable[[], Callable[[str], Iterator[tuple[str, str]]]]:
    """An analyzer for ``noun_tokens`` and ``Storefront(korean_analyzer=...)``.

    The dictionary does not grow with the reviews; it is counted, and sent to the workers once, with at most ``max_words`` rows.
    """

    def rows(df: DataFrame, keys: list[str]) -> list[list]:
        clean = df.select(*[F.col(k).cast("string").alias(k) for k in keys], F.col("cost").cast("bigint").alias("cost")).dropna()
        if "form" in keys:
            clean = clean.where((F.col("form") != "") & (F.col("tag") != "") & ~F.col("form").rlike(r"(?U)\s"))
        least = clean.groupBy(*keys).agg(F.min("cost").alias("cost")).orderBy(*keys)
        if (n := least.count()) > max_words:
            raise ValueError(f"{n} rows of a dictionary, {max_words} are allowed")
        return [c.to_pylist() for c in least.toArrow().columns]

    known = rows(words, ["form", "tag"])
    if not known[0]:
        raise ValueError("the dictionary has no words")
    shared = words.sparkSession.sparkContext.broadcast((known, rows(joins, ["left", "right"]) if joins is not None else [[], [], []]))

    def make() -> Callable[[str], Iterator[tuple[str, str]]]:
        known, met = shared.value
        return Lexicon(zip(*known), zip(*met)).analyze

    return make
