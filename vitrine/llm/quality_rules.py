"""Quality rules: base rules, and a decision list learned from labelled documents.

One Arrow pass turns a whole text into statistics. Sequential covering learns from the statistics of a bounded sample of labelled
documents (``sample`` rows with the smallest hash of their id): a rule for bad texts grows by the threshold of largest
information gain on two thirds of the rows, and is pruned from its end on the other third; covered rows go, and the next
rule grows. A rule that isn't precise enough on the pruning rows ends the list. The list becomes one ordered Spark ``when`` expression over the
statistics' columns, readable and without Python.

Defined cases: a null text has no words; documents without labels train nothing; without labels the list is empty and keeps all that
pass the base rules; labels of unknown documents are ignored; of several labels of one document each counts once; ids may be of any type; repeated
documents don't enlarge the sample; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scan

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATES = ["mean_word", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "digit_rate", "stop_rate", "words_per_line", "distinct_rate", "bang_rate", "pipe_rate"]
SYMBOLS = frozenset("#*$%&|<>")
_SYMBOL_BYTES = bytes(ord(c) for c in sorted(SYMBOLS))
_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))


def words_of(raw: bytes) -> list[bytes]:
    """Runs of anything but the six ASCII white-space characters."""
    return raw.split()


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more, first places included."""
    n = len(words)
    if n <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    h = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        h = (h ^ ids[k : n - width + 1 + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    found = np.zeros(len(h), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    places: dict[tuple[int, ...], list[int]] = {}
    for at in np.flatnonzero(found).tolist():  # equal hashes are compared by words
        places.setdefault(tuple(ids[at : at + width].tolist()), []).append(at)
    edge = np.zeros(n + 1, np.int64)
    for at in places.values():
        if len(at) > 1:
            np.add.at(edge, at, 1)
            np.add.at(edge, np.array(at) + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def statistics(raw: bytes | None) -> tuple:
    raw = raw or b""
    words = words_of(raw)
    n = len(words)
    if not n:
        return (0, 0, len(raw) - len(raw.translate(None, _SYMBOL_BYTES)), 0, 0, *[0.0] * len(RATES))
    solid = b"".join(words)
    chars = len(solid.decode("utf-8", "replace"))
    symbols = len(raw) - len(raw.translate(None, _SYMBOL_BYTES))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    duplicates = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    count = lambda s: len(solid) - len(solid.translate(None, s))
    distinct = len(set(words))
    short = sum(1 for w in words if len(w) <= 3)
    return (
        n, chars, symbols, duplicates, repeats,
        chars / n, symbols / chars, duplicates / len(lines), repeats / n, count(_UPPER) / chars, count(_DIGIT) / chars, short / n, n / len(lines),
        distinct / n, count(b"!") / chars, count(b"|") / chars,
    )


def with_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    kinds = [*[f"{c} bigint" for c in BASE], *[f"{c} double" for c in RATES]]

    def make():
        def f(texts: pa.Array) -> list:
            raw = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()).to_pylist()
            cols = list(zip(*map(statistics, raw))) if raw else [()] * len(kinds)
            return [pa.array(c, pa.int64() if i < len(BASE) else pa.float64()) for i, c in enumerate(cols)]

        return f

    return scan(docs.withColumn(text, F.col(text).cast("string")), [text], ", ".join(kinds), make, keep)


# ---- learning


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= threshold, else value < threshold
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.above else x[self.feature] < self.threshold

    def column(self) -> Column:
        return F.col(self.feature) >= self.threshold if self.above else F.col(self.feature) < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int) -> Rule:
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < most and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best, gain = None, 0.0
        base = np.log2(p0 / (p0 + n0))
        for f, v in x.items():
            order = np.argsort(v[inside], kind="stable")
            s, y = v[inside][order], bad[inside][order]
            at = np.flatnonzero(s[1:] != s[:-1]) + 1  # places where the value changes
            if not len(at):
                continue
            below = np.cumsum(y)[at - 1].astype(float)
            for above, p, n in ((True, p0 - below, (len(s) - at) - (p0 - below)), (False, below, at - below)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(p > 0, p * (np.log2(p / (p + n)) - base), 0)
                i = int(g.argmax())
                if g[i] > gain + 1e-9:
                    best, gain = Condition(f, above, float((s[at[i]] + s[at[i] - 1]) / 2)), g[i]
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x)
    return tuple(rule)


def learn(x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.9, support: int = 5, rules: int = 24, conditions: int = 4) -> list[Rule]:
    """Ordered rules for bad rows; every third row prunes."""
    out: list[Rule] = []
    left = np.ones(len(bad), bool)
    third = np.arange(len(bad)) % 3 == 2
    while len(out) < rules and (left & bad & ~third).sum() >= support:
        grow, prune = left & ~third, left & third
        rule = _grow({f: v[grow] for f, v in x.items()}, bad[grow], conditions)
        at = {f: v[prune] for f, v in x.items()}

        def worth(r: Rule) -> float:
            inside = _all(r, at, int(prune.sum()))
            p, n = (inside & bad[prune]).sum(), (inside & ~bad[prune]).sum()
            return (p - n) / (p + n) if p + n else -1.0

        shorter = [rule[:k] for k in range(1, len(rule) + 1)]
        if not shorter:
            break
        rule = max(shorter, key=lambda r: (worth(r), -len(r)))
        inside = _all(rule, x, len(bad)) & left
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        q = _all(rule, at, int(prune.sum()))
        hit, miss = (q & bad[prune]).sum(), (q & ~bad[prune]).sum()
        if p < support or p < precision * (p + n) or hit + 1 < precision * (hit + miss + 1):
            break
        out.append(rule)
        left &= ~inside
    return out


def labelled_statistics(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = 20_000) -> DataFrame:
    """Statistics and quality of at most ``sample`` labelled documents, one row for each id and label (of several texts of one id the least statistics), in
    ``mark`` a hash of the id; only their ids are broadcast."""
    pairs = labels.where(F.col("quality").isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("__id"), F.col("quality").alias("__quality")).distinct()
    chosen = pairs.orderBy(F.xxhash64("__id"), "__id", "__quality").limit(sample)
    own = docs.select(F.col(doc_id).alias("own"), F.col(text).cast("string").alias("text")).join(F.broadcast(chosen), F.col("own") == F.col("__id"))
    features = [*BASE, *RATES]
    one = with_statistics(own, "text", ["__id", "__quality"]).groupBy("__id", "__quality").agg(F.min(F.struct(*features)).alias("s"))
    return one.select(F.xxhash64("__id").alias("mark"), F.col("__quality").alias("quality"), "s.*")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = 20_000, **options) -> list[Rule]:
    rows = labelled_statistics(docs, labels, doc_id, text, sample).toPandas()
    if rows.empty:
        return []
    features = [*BASE, *RATES]
    # By a hash: the order of ids must not decide which rows prune. Ties of a threshold's gain go to the feature named first, and its lowest value.
    rows = rows.sort_values(["mark", "quality", *features], kind="stable")
    return learn({f: rows[f].to_numpy(float) for f in features}, rows["quality"].to_numpy() == 0, **options)


def verdict(rules: list[Rule]) -> Column:
    """True where no rule holds; one ordered conditional expression."""
    if not rules:
        return F.lit(True)
    out = None
    for rule in rules:
        cond = rule[0].column()
        for c in rule[1:]:
            cond = cond & c.column()
        out = F.when(cond, F.lit(False)) if out is None else out.when(cond, F.lit(False))
    return out.otherwise(True)


def rule_number(rules: list[Rule]) -> Column:
    """1 for the first rule and so on; 0 where none holds."""
    out = F.when(F.lit(False), 0)
    for i, rule in enumerate(rules, 1):
        cond = rule[0].column()
        for c in rule[1:]:
            cond = cond & c.column()
        out = out.when(cond, i)
    return out.otherwise(0)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
