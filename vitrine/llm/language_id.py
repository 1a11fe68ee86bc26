"""Language identification by nearest centroid.

A text is a vector of hashed byte 2- and 3-grams of its lower-cased letters: sub-linear counts, times inverse document frequency,
normalised. Each language has several centroids, found by spherical k-means on a bounded sample of labelled texts
(``per_language`` documents of each language, those with the smallest hash of their id, drawn by the counts of all; texts are whole). A text gets the language of
the centroid with the largest cosine. It is rejected if that cosine lies far below what training texts of its length
reach (``margin`` times the lowest in the band of its length), which no text does that is written in a learned language. Short
texts may be rare in the sample, so each of its texts also gives a short window for each low band: these have a floor at any table size.

The model is one small matrix, broadcast; scoring is one pass without a shuffle, in blocks of ``BLOCK`` texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected; without any labelled text all are ``und``;
rows with a null language or id train nothing (but are predicted); repeated rows are predicted alike, and train once; of equal cosines the language that sorts
first wins; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, scan

DIM, BLOCK, UNKNOWN = 4096, 128, "und"
#: Counts of more labels than this are joined by a shuffle.
MOST_LANGUAGES = 10_000
#: ASCII characters that are no letters become blanks.
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")
_PART = 1 << 20
#: The highest band with windows, which are of 2 to 1023 grams; how many make a floor, and what share of them may lie below (windows of junk).
WINDOWS, ENOUGH, BELOW = 9, 20, 0.01


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed byte 2- and 3-grams; a long text is counted part by part, and no gram is lost between parts."""
    out = np.zeros(DIM, np.int64)
    raw = b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" "
    for at in range(0, max(1, len(raw) - 2), _PART):
        a = np.frombuffer(raw[at : at + _PART + 2], np.uint8).astype(np.uint32)
        two = a[:-2] * np.uint32(0x9E3779B1) ^ a[1:-1] * np.uint32(0x85EBCA6B)
        three = two * np.uint32(0x27D4EB2F) ^ a[2:] * np.uint32(0xC2B2AE35)
        out += np.bincount(((two >> np.uint32(13)) % np.uint32(DIM // 4)).astype(np.int64), minlength=DIM)
        out += np.bincount((np.uint32(DIM // 4) + (three >> np.uint32(11)) % np.uint32(DIM - DIM // 4)).astype(np.int64), minlength=DIM)
    return out


def windows(text: str) -> list[str]:
    """A piece of the text's letters for each band up to ``WINDOWS`` that it is long enough for, from the start of a word on."""
    raw = b" ".join(text.lower().encode().translate(_LETTERS).split())
    starts = [0, *(i + 1 for i, c in enumerate(raw[: 1 << WINDOWS]) if c == 32)]
    out = []
    for b in range(1, WINDOWS + 1):
        at = starts[zlib.crc32(raw[: 1 << WINDOWS], b) % len(starts)]
        size = max(1, 3 << b >> 2)  # two grams for each byte
        piece = raw[at : at + size].decode(errors="ignore").strip()
        if at + size <= len(raw) and piece:
            out.append(piece)
    return out


@dataclass
class Centroids:
    languages: list[str]
    idf: np.ndarray
    centres: np.ndarray
    owner: np.ndarray
    floors: np.ndarray  # by band of length

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts.astype(np.float32)) * self.idf
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        return v / np.where(norm > 0, norm, 1)

    def score(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        counts = np.stack([gram_counts(t) for t in texts])
        cos = self.vectors(counts) @ self.centres.T
        best = cos.argmax(1)
        top = np.clip(cos[np.arange(len(texts)), best], 0, 1).astype(float)
        low = top < self.floors[band(counts.sum(1))]
        return [self.languages[i] for i in self.owner[best]], top.tolist(), low.tolist()


def band(n_grams: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n_grams, 1)).astype(int), 20)


def _kmeans(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts are the mean and then what lies farthest from all starts."""
    centres = v.mean(0, keepdims=True)
    while len(centres) < min(k, len(v)):
        centres = np.vstack([centres, v[(v @ centres.T).max(1).argmin()]])
    for _ in range(rounds):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
        own = (v @ centres.T).argmax(1)
        centres = np.stack([v[own == i].mean(0) if (own == i).any() else centres[i] for i in range(len(centres))])
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)


def fit(docs: DataFrame, trains: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", per_language: int = 600, clusters: int = 3, margin: float = 0.5) -> Centroids | None:
    """Centroids from rows where ``trains`` holds, of at most ``per_language`` documents of each language. The first pass reads ids and languages only.

    Counts, k-means and floors are made language by language in tasks; the driver gets a row of document counts and ``clusters`` centres
    for each language, which are the model.
    """
    labelled = docs.where(trains & F.col(lang).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("__id"), F.col(lang).alias("__lang"))
    # By the counts, hashes under a bound that about four times the sample lies below: few rows of a language meet in a task, at any size.
    # Ids are counted, not rows: few, often repeated ids still give a sample.
    counts = cut(labelled.groupBy("__lang").agg(F.approx_count_distinct("__id").alias("n")))
    side = F.broadcast(counts) if counts.count() <= MOST_LANGUAGES else counts
    draw = (F.shiftrightunsigned(F.xxhash64("__id"), 11).cast("double") + 0.5) / float(1 << 53)
    low = labelled.withColumn("draw", draw).join(side, "__lang").where(F.col("draw") * F.col("n") < 4 * per_language).select("__lang", "draw", "__id").distinct()
    order = Window.partitionBy("__lang").orderBy("draw", "__id")
    ids = low.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= per_language).select("__id").distinct()

    def packed(c: np.ndarray) -> bytes:
        at = np.flatnonzero(c)
        return at.astype("<u2").tobytes() + c[at].astype("<f4").tobytes()

    def unpacked(grams: list) -> np.ndarray:
        out = np.zeros((len(grams), DIM), np.float32)
        for row, g in zip(out, grams):
            n = len(g) // 6
            row[np.frombuffer(g, "<u2", n)] = np.frombuffer(g, "<f4", n, 2 * n)
        return out

    def make():
        def f(texts: pa.Array) -> list:
            out, short = [], []
            for t in texts.to_pylist():
                c = gram_counts(t) if has_letter(t) else np.zeros(DIM, np.int64)
                out.append(packed(c))
                short.append([packed(gram_counts(w)) for w in windows(t)] if len(out[-1]) else [])
            return [pa.array(out, pa.binary()), pa.array(short, pa.list_(pa.binary()))]

        return f

    # ids: at most per_language rows of each language; a label set beyond the bound is joined by a shuffle.
    few = F.broadcast(ids) if counts.count() <= MOST_LANGUAGES else ids
    own = docs.where(trains & F.col(lang).isNotNull()).select(F.col(doc_id).alias("__own"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    chosen = own.join(few, F.col("__own") == F.col("__id"), "left_semi")
    packed_rows = scan(chosen, ["text"], "grams binary, windows array<binary>", make, ["__own", "lang"])
    # One row for each id and language, whatever repeats.
    once = packed_rows.groupBy("__own", "lang").agg(F.min(F.struct("grams", "windows")).alias("x")).select("lang", "x.grams", "x.windows")
    # At most per_language rows of a language: a task holds the dense counts of one language at a time.
    of = cut(once.where(F.octet_length("grams") > 0)).groupBy("lang")

    def seen_in(rows):
        return pd.DataFrame({"lang": rows["lang"][:1], "n": len(rows), "seen": [(unpacked(rows["grams"]) > 0).sum(0).astype("<i4").tobytes()]})

    seen = sorted(of.applyInPandas(seen_in, "lang string, n long, seen binary").collect(), key=lambda r: r["lang"])
    if not seen:
        return None
    total = np.sum([np.frombuffer(r["seen"], "<i4") for r in seen], axis=0, dtype=np.int64)
    idf = (np.log((1 + sum(r["n"] for r in seen)) / (1 + total)) + 1).astype(np.float32)
    model = Centroids([r["lang"] for r in seen], idf, np.empty((0, DIM)), np.empty(0, int), np.zeros(21))

    def centres_of(rows):
        found = _kmeans(model.vectors(unpacked(sorted(rows["grams"]))), clusters)
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]] * len(found), "i": range(len(found)), "centre": [x.astype("<f4").tobytes() for x in found]})

    found = sorted(of.applyInPandas(centres_of, "lang string, i int, centre binary").collect(), key=lambda r: (r["lang"], r["i"]))
    at = {x: i for i, x in enumerate(model.languages)}
    model.centres = np.stack([np.frombuffer(r["centre"], "<f4") for r in found])
    model.owner = np.array([at[r["lang"]] for r in found])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def reach_of(rows):
        """The least cosine of the texts of each band, and the low quantile of the windows of each."""
        own = shared.value
        dense = unpacked(rows["grams"])
        top, bands = (own.vectors(dense) @ own.centres.T).max(1), band(dense.sum(1))
        out = [("text", int(b), int((bands == b).sum()), float(top[bands == b].min())) for b in np.unique(bands)]
        reached: dict[int, list[float]] = {}
        for some in rows["windows"]:
            if len(some):
                short = unpacked(some)
                for b, x in zip(band(short.sum(1)).tolist(), (own.vectors(short) @ own.centres.T).max(1).tolist()):
                    reached.setdefault(b, []).append(x)
        out += [("window", b, len(x), float(np.quantile(x, BELOW))) for b, x in reached.items()]
        return pd.DataFrame(out, columns=["kind", "band", "n", "least"])

    reach = of.applyInPandas(reach_of, "kind string, band int, n long, least double")
    texts: dict[int, tuple[int, float]] = {}
    pieces = []
    for r in reach.collect():
        if r["kind"] == "text":
            n, least = texts.get(r["band"], (0, 1.0))
            texts[r["band"]] = n + r["n"], min(least, r["least"])
        elif r["n"] >= ENOUGH:
            pieces.append((r["band"], r["least"]))
    lowest = {b: least for b, (n, least) in texts.items() if n >= ENOUGH}
    for b, x in pieces:
        lowest[b] = min(lowest.get(b, 1.0), x)
    for b in range(1, WINDOWS + 1):  # longer pieces don't score less
        if b in lowest and b - 1 in lowest:
            lowest[b] = max(lowest[b], lowest[b - 1])
    for b in texts.keys() & lowest.keys():  # a training text is never rejected
        lowest[b] = min(lowest[b], texts[b][1])
    # A band without enough takes the one below, where texts are shorter; those below all others, less by the root of their length.
    first = min(lowest, default=None)
    for b in range(21):
        if first is None:
            model.floors[b] = margin * min(x for _, x in texts.values()) * 0.5 ** (max(0, min(texts) - b) / 2)
        elif b < first:
            model.floors[b] = margin * lowest[first] * 0.5 ** ((first - b) / 2)
        else:
            model.floors[b] = margin * lowest[b] if b in lowest else model.floors[b - 1]
    return model


def identify(docs: DataFrame, model: Centroids | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with lang_pred, score and lang_rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own = shared.value

        def f(texts: pa.Array) -> list:
            rows = texts.to_pylist()
            lang, score, low = [UNKNOWN] * len(rows), [0.0] * len(rows), [True] * len(rows)
            at = [i for i, t in enumerate(rows) if has_letter(t)] if own is not None else []
            for a in range(0, len(at), BLOCK):
                part = at[a : a + BLOCK]
                for i, *x in zip(part, *own.score([rows[i] for i in part])):
                    lang[i], score[i], low[i] = x
            return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(low, pa.bool_())]

        return f

    return scan(docs.withColumn(text, F.col(text).cast("string")), [text], "lang_pred string, score double, lang_rejected boolean", make, keep)


def held_out(doc_id: str = "doc_id") -> Column:
    """A fifth of the documents, by checksum of the id; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
