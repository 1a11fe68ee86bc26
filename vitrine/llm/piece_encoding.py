"""SentencePiece encoding and decoding for merge-type (BPE) models, by a prefix table.

Merging gives every prefix of a text one last token, and a row of tokens is what merging gives exactly if all its neighbours
are compatible: merging the text of two neighbours gives the two again. So the table is filled left to right: of all pieces that an
automaton finds ending at a position, the one that is compatible with the last token of the prefix before it is stored; the ids
are then recovered backwards from the end. That takes time in proportion to the text, whatever its length; compatibility
tests are remembered by pair.

No piece of these models has a blank mark behind another character, so merges never reach across the start of a word; nor do they
across any two neighbours that stand side by side in no piece. The table is filled for each part between such places, and the ids of
short words and parts are remembered, as text, in two tables of at most ``REMEMBERED`` entries each (some 160 bytes an entry: 65 MB a worker). A part's ids are decoded when they are found; since
they give the part again, a text decodes to itself, but for parts that differ, which are kept. :class:`PieceCodec` checks this
property, and a fixed set of probes against the library, when it loads a model, and refuses models that differ (other
normalizers, other types).

Defined cases: null and empty texts have no ids and decode to the empty text; characters without a piece become byte pieces;
U+2581 decodes to a blank, as in the library; an output column replaces a column of its name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, scan

MARK = "▁"
REMEMBERED, REMEMBERED_CHARS, PAIRS = 200_000, 48, 300_000
#: Numbers of characters without a piece start here; a pair of numbers is one number to this base.
LONE, WIDE = 1 << 24, 1 << 26
PROBES = ("", " ", "  a\tb  c\n", "Hello, world! 123 456", "ﬁ é① 你好 \U0001f600 é", "aaaa  aaaaa\n\n\n    x=1;\ty", "<s> </s> <unk> <0x41>", f"a{MARK}b {MARK}", "İıſ K ½", " 　x​", "ß" * 30, "internationalization antidisestablishmentarianism")


class PieceCodec:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        normal = {p: i for i, p in enumerate(self.pieces) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        self.ids, self.score = normal, {p: sp.get_score(i) for p, i in normal.items()}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(len(self.pieces)) if sp.is_byte(i)}
        self.raw = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else b" \xe2\x81\x87 " if sp.is_unknown(i) else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        if len(self.bytes) != 256:
            raise ValueError(f"{path}: no byte pieces")
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in normal):
            raise ValueError(f"{path}: a piece reaches across words")
        self.beside = {p[i : i + 2] for p in normal for i in range(len(p) - 1)}
        self.runs = self._kinds()
        self.machine = ahocorasick.Automaton()
        for p, i in normal.items():
            self.machine.add_word(p, (i, len(p)))
        self.machine.make_automaton()
        #: Ids by part, blanks for marks; the older half is dropped when the newer is full.
        self.known: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.old: dict[str, bytes] = {}
        #: What parts decode to that don't give themselves.
        self.differs: dict[str, bytes] = {}
        for probe in PROBES:
            if self.encode(probe) != sp.encode(probe) or self.decode(self.encode(probe)) != sp.decode(sp.encode(probe)).encode():
                raise ValueError(f"{path}: this model encodes {probe!r} by other rules")

    def _kinds(self) -> re.Pattern | None:
        """Blanks with the run behind them, of two kinds of characters that no piece has side by side: ASCII characters that are no
        letters, with what stands beside them in a piece, and all others. None where the kinds can't be told apart."""
        pairs = [b for b in self.beside if MARK not in b]
        other = {c for b in pairs for c in b if c < "\x80" and not c.isalpha()}
        while more := {c for b in pairs if (b[0] in other) != (b[1] in other) for c in b} - other:
            other |= more
        if any(c.isalpha() and c < "\x80" for c in other):
            return None
        extra = "".join(re.escape(c) for c in sorted(other) if c >= "\x80")
        return re.compile(rf" *[^\x00-@\[-`{{-\x7f{extra}]+| *[\x00-\x1f!-@\[-`{{-\x7f{extra}]+| +")

    # ---- merging, for pieces and pairs only

    def _best(self, parts: list[str]) -> int:
        """Where the neighbours stand whose union scores best, the leftmost of equals; -1 if none is a piece."""
        best, at, score = None, -1, self.score
        for i in range(len(parts) - 1):
            s = score.get(parts[i] + parts[i + 1])
            if s is not None and (best is None or s > best):
                best, at = s, i
        return at

    def _text(self, token: int) -> str:
        return chr(token - LONE) if token >= LONE else self.pieces[token] if token >= 0 else ""

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """What the last merge of a piece joins; none if merging doesn't give the piece."""
        if (found := self.halves.get(piece, 0)) == 0:
            parts, last = list(piece), None
            while len(parts) > 1:
                at = self._best(parts)
                if at < 0:
                    break
                last = (parts[at], parts[at + 1])
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            found = self.halves[piece] = last if len(parts) == 1 else None
        return found

    def _compatible(self, left: int, right: int, key: int) -> bool:
        """Merging both gives both again; ``left`` -1 is the start of the part.

        Goes back in time: the younger of the two is taken apart, and if what then stands side by side would have merged
        before it was made, the pair can't be.
        """
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        found = self.pairs[key] = self._stays(self._text(left), self._text(right))
        return found

    def _stays(self, x: str, y: str) -> bool:
        score, always = self.score, float("inf")
        if len(y) > 1 and self._halves(y) is None:
            return False
        if not x:
            return True
        if x + y in score:
            return False
        sx = score[x] if len(x) > 1 else always
        sy = score[y] if len(y) > 1 else always
        while True:
            if sx < sy:
                limit, x = sx, self._halves(x)[1]
                sx = score[x] if len(x) > 1 else always
                if score.get(x + y, -always) > limit:
                    return False
            elif len(y) > 1:
                limit, y = sy, self._halves(y)[0]
                sy = score[y] if len(y) > 1 else always
                if score.get(x + y, -always) >= limit:
                    return False
            else:
                return True

    # ---- the table

    def tokens(self, part: str) -> list[int]:
        """Ids of a part from its prefix table; a character without a piece is ``LONE`` and its number."""
        last, size, solved, pairs = [-1], [0], -1, self.pairs.get  # by length of the prefix; solved: its last end
        for end, (token, length) in self.machine.iter(part):  # longest first at each end
            if end == solved:
                continue
            while solved + 1 < end:
                solved += 1
                last.append(LONE + ord(part[solved]))
                size.append(1)
            left = last[end + 1 - length]
            key = left * WIDE + token
            ok = pairs(key)
            if ok is None:
                ok = self._compatible(left, token, key)
            if ok:
                last.append(token)
                size.append(length)
                solved = end
        for c in part[solved + 1 :]:
            last.append(LONE + ord(c))
            size.append(1)
        out, at = [], len(part)
        while at:
            out.append(last[at])
            at -= size[at]
        out.reverse()
        return out

    def _part(self, part: str) -> bytes:
        """The ids of a part, joined by commas."""
        if (found := self.old.get(part)) is None:
            ids = self.tokens(part.replace(" ", MARK))
            if max(ids) >= LONE:
                ids = [i for t in ids for i in ([t] if t < LONE else [self.bytes[b] for b in chr(t - LONE).encode()])]
            found = ",".join(map(str, ids)).encode()
            if (decoded := b"".join([self.raw[i] for i in ids])) != part.encode():
                self.differs[part] = decoded
        if len(part) <= REMEMBERED_CHARS:
            if len(self.known) >= REMEMBERED:
                self.known, self.old = {}, self.known
            self.known[part] = found
        return found

    def parts(self, text: str) -> tuple[list[str], list[bytes]]:
        """The parts of a text in order and their ids; the library puts one blank before the first."""
        text = " " + text.replace(MARK, " ")
        if self.runs:
            parts = self.runs.findall(text)
        else:
            marked, beside = text.replace(" ", MARK), self.beside
            cuts = [i for i, pair in enumerate(map(add, marked, marked[1:]), 1) if pair not in beside]
            parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        out, make = [], self._part
        for a in range(0, len(parts), 4096):  # the table may be a new one after each batch
            get = self.known.get
            out += [get(p) or make(p) for p in parts[a : a + 4096]]
        return parts, out

    # ---- whole texts

    def joined(self, text: str | None) -> tuple[bytes, bytes]:
        """(ids joined by commas, decoded text in UTF-8)"""
        if not text:
            return b"", b""
        parts, ids = self.parts(text)
        if self.differs and not self.differs.keys().isdisjoint(parts):
            decoded = b"".join([self.differs.get(p) or p.encode() for p in parts])[1:]
        else:
            decoded = text.replace(MARK, " ").encode()
        return b",".join(ids), decoded

    def encode(self, text: str | None) -> list[int]:
        ids = self.joined(text)[0]
        return [int(i) for i in ids.split(b",")] if ids else []

    def decode(self, ids: list[int]) -> bytes:
        """Text of ids in UTF-8; bytes that are no character become U+FFFD, the blank in front goes."""
        raw = self.raw
        out = b"".join([raw[i] for i in ids])
        out = out[1:] if out[:1] == b" " and self.pieces[ids[0]][:1] == MARK else out
        return out.decode("utf-8", "replace").encode()


def load_codec(path: str) -> PieceCodec:
    """One codec for each Python worker, for all its tasks that encode or decode one after the other."""
    return held(PieceCodec, path)


def _with_codec(path: str, f: Callable):
    def make():
        codec = load_codec(path)
        return lambda column: f(codec, column)

    return make


def _id_lists(joined: list[bytes]) -> pa.Array:
    """Ids of all texts as one list column, never as Python numbers."""
    each = [np.fromstring(x.decode(), np.int32, sep=",") if x else np.empty(0, np.int32) for x in joined]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *each])))


def encode_column(df: DataFrame, path: str, text: str = "text", out: str = "ids", keep: list[str] | None = None) -> DataFrame:
    f = lambda codec, column: [_id_lists([codec.joined(t)[0] for t in column.to_pylist()])]
    return scan(df.withColumn(text, F.col(text).cast("string")), [text], f"`{out}` array<int>", _with_codec(path, f), keep)


def decode_column(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    f = lambda codec, column: [pa.array([codec.decode(x or []).decode() for x in column.to_pylist()], pa.string())]
    return scan(df, [ids], f"`{out}` string", _with_codec(path, f), keep)


def round_trip(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, ids: bool = False) -> DataFrame:
    """Encodes and decodes each text in one pass: n_tokens, ids_sha256 and decoded_sha256, and the ids if wanted."""

    def f(codec, column):
        joined, n, coded, decoded = [], [], [], []
        for t in column.to_pylist():
            x, y = codec.joined(t)
            n.append(x.count(b",") + 1 if x else 0)
            coded.append(hashlib.sha256(x).hexdigest())
            decoded.append(hashlib.sha256(y).hexdigest())
            if ids:
                joined.append(x)
        return [pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string()), *([_id_lists(joined)] if ids else [])]

    made = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return scan(df.withColumn(text, F.col(text).cast("string")), [text], made, _with_codec(path, f), keep)
