"""Benchmark decontamination: windows of benchmark words, looked up in whole training texts.

A text is lower-cased (A-Z only) and cut into words of digits, letters and non-ASCII characters. Every ``n``
consecutive words of an item are a window; an item of fewer words is one window of all its words. The
windows travel to the executors as a hash set whose size is bounded: above ``max_windows`` they are split into blocks by
hash, and the documents are scanned once for each block, with the rows written between, so that no worker
ever holds more than one block. The scan compares 64-bit rolling hashes of word numbers and verifies each candidate
against the window itself. Nothing is shuffled.

Defined cases: a null or wordless text has no words and no hits; an item without words has no window; an item with a null id
marks words but is not named; rows of one item id are one item; repeated documents are judged one by one; a column of
the documents named like the result column is replaced.
"""

from __future__ import annotations

from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, cut, scan

#: A-Z to a-z, digits, letters and bytes of non-ASCII characters kept, all else to blanks.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_PART = 1 << 20
RESULT = "struct<n_words:bigint,spans:array<struct<first:int,end:int>>,items:array<string>>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


class WindowIndex:
    """Distinct windows as rows of word numbers, by length and sorted by a 64-bit hash, each with a list of its items; a ten-word window takes some 70 bytes.

    A window stands once, however many items share it: a text pays for its items only where the window occurs in it.
    """

    def __init__(self, items: pa.Array, windows: pa.Array):
        """Distinct (item, window) rows, as :func:`item_windows` gives them; items that are null mark words only."""
        self.words: dict[bytes, int] = {}
        names = items.dictionary_encode()
        self.names: list[str] = names.dictionary.to_pylist()
        owner = names.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
        once = windows.dictionary_encode()
        of = once.indices.to_numpy(zero_copy_only=False)
        numbers, sizes = array("i"), array("i")
        for w in once.dictionary:
            ids = [self.words.setdefault(x, len(self.words)) for x in w.as_py().split(b" ")]
            numbers.extend(ids)
            sizes.append(len(ids))
        flat, size = np.array(numbers, np.int32), np.array(sizes, np.int32)
        starts = np.cumsum(size, dtype=np.int64) - size
        #: Items of window w: those from first[w] to first[w + 1].
        of, owner = of[owner >= 0], owner[owner >= 0]
        self.items = owner[np.argsort(of, kind="stable")]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(size)))])
        #: By length: sorted hashes, word numbers and window of each row, and the most rows of one hash.
        self.rows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, int]] = {}
        for n in np.unique(size).tolist():
            mine = np.flatnonzero(size == n)
            h = self._hash(flat, starts[mine], n)
            order = np.argsort(h, kind="stable")
            _, equal = np.unique(h, return_counts=True)
            self.rows[n] = h[order], flat[starts[mine][order][:, None] + np.arange(n)], mine[order].astype(np.int32), int(equal.max())

    @staticmethod
    def _hash(ids: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        h = np.zeros(len(starts), np.uint64)
        for k in range(n):
            h = (h ^ ids[starts + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def numbers(self, text: bytes | None) -> np.ndarray:
        """Word numbers of a text (-1: in no window), part by part, so that a huge text is never a list of words at once."""
        if not text:
            return np.empty(0, np.int32)
        plain, parts, at, get = text.translate(_WORD_BYTES), [], 0, self.words.get
        while at < len(plain):
            end = len(plain) if len(plain) - at <= _PART else plain.find(b" ", at + _PART)
            end = len(plain) if end < 0 else end
            words = plain[at:end].split()
            parts.append(np.fromiter(map(get, words, repeat(-1)), np.int32, len(words)))
            at = end
        return np.concatenate(parts) if len(parts) > 1 else parts[0]

    def search(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """(word spans of occurrences, items named) of one text."""
        spans, found = [], []
        if not len(ids):
            return spans, set()
        strange = np.concatenate(([0], np.cumsum(ids < 0)))
        for n, (hashes, numbers, window, most) in self.rows.items():
            if len(ids) < n:
                continue
            starts = np.flatnonzero(strange[n:] == strange[:-n])
            if not len(starts):
                continue
            h = self._hash(ids, starts, n)
            at = np.searchsorted(hashes, h)
            hit = np.zeros(len(starts), bool)
            for k in range(most):  # rows of one hash: windows that collide
                row = np.minimum(at + k, len(hashes) - 1)
                same = np.flatnonzero((hashes[row] == h) & (at + k < len(hashes)))
                same = same[(numbers[row[same]] == ids[starts[same][:, None] + np.arange(n)]).all(1)]
                hit[same] = True
                found.append(np.unique(window[row[same]]))
            spans += [(s, s + n) for s in starts[hit].tolist()]
        if not spans:
            return spans, set()
        named, found = np.zeros(len(self.names), bool), np.concatenate(found)
        for a, b in zip(self.first[found].tolist(), self.first[found + 1].tolist()):
            named[self.items[a:b]] = True
        return spans, {self.names[i] for i in np.flatnonzero(named).tolist()}


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [tuple(x) for x in out]


def item_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", n: int = 10) -> DataFrame:
    """Distinct (item, window) rows; a window is its words joined by blanks."""

    def make():
        def f(items: pa.Array, texts: pa.Array) -> list:
            out = []
            for t in as_bytes(texts):
                w = words_of(t)
                out.append([b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else [])
            return [items, pa.array(out, pa.list_(pa.binary()))]

        return f

    plain = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return scan(plain, ["item", "text"], "item string, windows array<binary>", make, []).select("item", F.explode("windows").alias("window")).distinct()


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", n: int = 10, result: str = "overlap", max_windows: int = 1_000_000, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the struct column ``result``: n_words, spans of hit words (merged, end exclusive) and sorted items."""
    windows = cut(item_windows(benchmark, item, item_text, n))
    total = windows.count()
    blocks = max(1, -(-total // max_windows))
    names = [c for c in (docs.columns if keep is None else keep) if c != result]
    out = docs
    for block in range(blocks):
        rows = (windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block)).toArrow().combine_chunks()
        index = docs.sparkSession.sparkContext.broadcast(WindowIndex(*[c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in rows.columns]))

        def make(index=index, first=block == 0):
            own = index.value

            def f(texts: pa.Array, *before: pa.Array) -> list:
                n_words, spans, items = [], [], []
                old = before[0].to_pylist() if before else repeat(None)
                for t, was in zip(as_bytes(texts), old):
                    ids = own.numbers(t)
                    at, named = own.search(ids)
                    if was is not None:
                        at += [(x["first"], x["end"]) for x in was["spans"]]
                        named |= set(was["items"])
                    n_words.append(len(ids))
                    spans.append([{"first": a, "end": b} for a, b in _merged(at)])
                    items.append(sorted(named))
                kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string()))])
                return [pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(spans, kind[1].type), pa.array(items, kind[2].type)], fields=list(kind))]

            return f

        last = block == blocks - 1
        carried = names if last else list(dict.fromkeys([*names, text]))
        out = scan(out, [text] if block == 0 else [text, result], f"`{result}` {RESULT}", make, carried)
        if not last:
            out = cut(out)
    return out


def hit_words(result: str = "overlap") -> Column:
    return F.aggregate(F.col(result)["spans"], F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["first"]).cast("long"))


def _free(docs: DataFrame) -> str:
    """A column name that ``docs`` doesn't have."""
    name = "overlap"
    while name in docs.columns:
        name += "_"
    return name


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """Documents without any benchmark window, unchanged."""
    mark = _free(docs)
    marked = find_overlaps(docs, benchmark, text, result=mark, **options)
    return marked.where(F.size(F.col(mark)["spans"]) == 0).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", mark: str = "\n\n", **options) -> DataFrame:
    """All documents; hit words, with what stands between them, give way to ``mark``."""
    found_in = _free(docs)
    marked = find_overlaps(docs, benchmark, text, result=found_in, **options)

    def make():
        import re

        word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

        def f(texts: pa.Array, found: pa.Array) -> list:
            out = []
            for t, o in zip(texts.to_pylist(), found.to_pylist()):
                if t and o["spans"]:
                    at = [(m.start(), m.end()) for m in word.finditer(t)]
                    parts, last = [], 0
                    for s in o["spans"]:
                        parts += [t[last : at[s["first"]][0]], mark]
                        last = at[s["end"] - 1][1]
                    t = "".join([*parts, t[last:]])
                out.append(t)
            return [pa.array(out, pa.string())]

        return f

    return scan(marked, [text, found_in], f"`{text}` string", make, [c for c in docs.columns if c != text]).select(*docs.columns)
