"""Token counts of whole texts: encoders in Arrow functions that return lengths only.

Texts over ``split_bytes`` are cut at safe boundaries, where no token can reach across; the pieces are
encoded as batches of about ``batch_bytes`` of UTF-8, so neither one long text nor many short ones decide a batch's memory. Nothing is
shuffled, and no ids leave the Python worker.

A ``.json`` vocabulary of byte-level BPE (no normalizer, the usual pattern) is encoded from its own table by the faster of two
libraries, which gives the same ids; other ``.json`` files by their own library; ``.model`` files by sentencepiece; ``.tiktoken``
files as ranks. Special strings inside texts are handled as the library of the file does by default.

Defined cases: null and empty texts have 0 tokens; repeated rows are counted one by one; an output column replaces a column of its name.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scan

BATCH_BYTES, SPLIT_BYTES = 1 << 20, 1 << 18
#: Fixed value: the pattern that byte-level vocabularies are cut with before merging.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A single blank, tab or line break between two characters that are no white space always starts a new piece of that pattern, and so
#: does one of these signs behind an ASCII letter.
_SAFE, _SAFE_SIGNS = re.compile(r"(?<=\S)[ \t\n](?=\S)|(?<=[A-Za-z])(?=[.,;:!?])"), frozenset(" \t\n.,;:!?")
#: White space of this length is left to the other library: the pattern's look-ahead backtracks over all of it.
_BLANKS = re.compile(r"\s{2000}")


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def split_text(text: str, size: int) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut at safe places only."""
    at = 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


def n_bytes(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode())


def balanced(pieces: Iterable[tuple[int, str]], size: int) -> Iterator[list[tuple[int, str]]]:
    """(row, piece) pairs in batches of about ``size`` bytes."""
    batch, held = [], 0
    for row, piece in pieces:
        batch.append((row, piece))
        held += n_bytes(piece)
        if held >= size:
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


@lru_cache(maxsize=4)
def load_counter(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """(lengths of a batch of texts, whether texts may be split at safe places) for a vocabulary file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)], False
    import tiktoken

    if path.endswith(".tiktoken"):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(x) for x in enc.encode_ordinary_batch(texts, num_threads=1)], True
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    by_library = lambda texts: [len(e) for e in own.encode_batch(texts, add_special_tokens=False)]
    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    pre, model = j.get("pre_tokenizer") or {}, j["model"]
    byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    plain = not j.get("normalizer") and model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    added = {t["content"]: t["id"] for t in j.get("added_tokens", [])}
    simple = not any(t.get(k) for t in j.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")) and not any(_SAFE_SIGNS & set(t) for t in added)
    if not (byte_level and plain and simple):
        return by_library, False
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    enc = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def lengths(texts: list[str]) -> list[int]:
        wide = [bool(_BLANKS.search(t)) for t in texts]
        fast = iter(enc.encode_batch([t for t, w in zip(texts, wide) if not w], num_threads=1, allowed_special="all"))
        slow = iter(by_library([t for t, w in zip(texts, wide) if w]))
        return [next(slow) if w else len(next(fast)) for w in wide]

    return lengths, True


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens", keep: list[str] | None = None, batch_bytes: int = BATCH_BYTES, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``df`` with the number of tokens of each text, without begin, end or other added tokens. ``path`` exists on every executor."""

    def make():
        lengths, splits = load_counter(path)

        def f(texts: pa.Array) -> list:
            rows = texts.to_pylist()
            counts = [0] * len(rows)
            pieces = ((i, p) for i, t in enumerate(rows) if t for p in (split_text(t, split_bytes) if splits and len(t) > split_bytes else (t,)))
            for batch in balanced(pieces, batch_bytes):
                for (i, _), n in zip(batch, lengths([p for _, p in batch])):
                    counts[i] += n
            return [pa.array(counts, pa.int64())]

        return f

    return scan(df.withColumn(text, F.col(text).cast("string")), [text], f"`{out}` bigint", make, keep)
