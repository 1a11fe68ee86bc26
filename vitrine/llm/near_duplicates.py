"""Near duplicates by 64-bit SimHash, linked at a Hamming distance, with pigeonring filtering.

A fingerprint is cut into ``m`` segments that stand in a ring. If two fingerprints differ in at most ``t`` bits, some run of
segments starts such that its first ``l`` segments together differ in fewer than ``l * (t + 1) / m`` bits, for every ``l`` from 1 to
``m`` (the pigeonring principle): so a chain starts at an intact segment, and at least ``m - t`` segments are intact.
Candidates share ``m - t`` intact segments; pairs without a chain within the proportional budgets are dropped before the full check.

Scale: equal fingerprints are one node, so copies never meet each other. ``m`` follows from the number of distinct
fingerprints, so that chance meets stay a few for each, at any size; no choice loses a link. In a bucket only the edges of a
spanning forest are emitted, never all pairs. A bucket of more than ``BUCKET`` fingerprints leaves the first round whole and is cut into
blocks; each two blocks are compared in a task of their own. Components come from alternating large and small stars, written
between the rounds; the driver sees counts only.

Defined cases: a null, empty or blank text has fingerprint 0, which links like any other; a null doc id takes part, and is the
component id only where no other row of the component has one; repeated rows are in one component; extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, cut, hot_keys, join_hot, scan, swept

BITS, SEED, BUCKET = 64, 42, 4096
#: Chance meets for each fingerprint that the choice of segments allows.
MEETS = 4
#: The Jaccard similarity of near copies, as a fraction.
SIMILAR = (4, 5)
#: Texts of the sample that finds common shingles (at least; or a fiftieth of all), and how many of them have a common one.
SAMPLE, OFTEN = 4096, 2
#: The most common shingles whose order is known to every task, 512 KB at any size of the corpus; others are ordered by hash.
COMMON = 1 << 16
#: Longs of parities of a set: pairs that these tell apart are not made.
WORDS = 8
#: More hashes than this are joined by a shuffle.
MOST_HASHES = 4_000_000


# ---- fingerprints


def fingerprint(text: bytes | None, width: int = 4) -> int:
    """Bits set in over half of the XXH64 of all ``width``-word shingles."""
    import xxhash

    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    plain = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1)[: len(words) - width + 1].tolist()
    ends, digest, votes = ends[width - 1 :].tolist(), xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for a in range(0, len(starts), 1 << 15):
        h = np.array([digest(plain[s:e], SEED) for s, e in zip(starts[a : a + (1 << 15)], ends[a : a + (1 << 15)])], np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", width: int = 4, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the fingerprint as a signed long."""

    def make():
        def f(texts: pa.Array) -> list:
            return [pa.array(np.array([fingerprint(t, width) for t in as_bytes(texts)], np.uint64).view(np.int64))]

        return f

    return scan(docs.withColumn(text, F.col(text).cast("string")), [text], f"`{out}` bigint", make, keep)


def hex_digits(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ---- segments and chains


def segments(m: int) -> list[int]:
    """Bit masks of ``m`` neighbouring segments of nearly equal width."""
    edges = [round(BITS * i / m) for i in range(m + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def choose_segments(n: int, t: int) -> int:
    """The fewest segments at which chance meets stay below ``MEETS`` for each of ``n`` fingerprints."""
    for m in range(t + 1, 17):
        if comb(m, t) * n <= MEETS * 2.0 ** (BITS * (m - t) / m):
            return m
    return 17


def has_chain(x: np.ndarray, m: int, t: int) -> np.ndarray:
    """Whether differences ``x`` have a chain of segments within the budgets of all its lengths."""
    each = np.stack([np.bitwise_count(x & np.uint64(s)) for s in segments(m)], 1).astype(np.int8)
    ring = np.cumsum(np.concatenate([np.zeros((len(x), 1), np.int8), each, each], 1), 1, dtype=np.int16)
    alive = np.ones((len(x), m), bool)
    for length in range(1, m + 1):
        budget = -(-length * (t + 1) // m) - 1
        alive &= ring[:, length : length + m] - ring[:, :m] <= budget
    return alive.any(1)


def linked(x: np.ndarray, m: int, t: int) -> np.ndarray:
    ok = has_chain(x, m, t)
    ok[ok] = np.bitwise_count(x[ok]) <= t
    return ok


def forest(fps: np.ndarray, m: int, t: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct fingerprints."""
    out, left = [], fps
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            here = todo.pop()
            near = linked(left ^ here, m, t)
            if near.any():
                found = left[near]
                out += [(int(here), int(x)) for x in found]
                todo += list(found)
                left = left[~near]
    return out


EDGES = "a bigint, b bigint, deferred int"


def _bucket_edges(m: int, t: int, limit: int | None):
    """Over rows (bucket columns, fp) sorted by bucket: edges, and the rows of buckets over ``limit`` as (key, fp, table)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: tuple[np.ndarray, ...] | None = None
        big: tuple | None = None  # the bucket that is being deferred

        def work(cols: tuple[np.ndarray, ...], last: bool):
            """Edges of all whole buckets; what may go on is the tail."""
            nonlocal tail, big
            *keys, fp = cols
            n = len(fp)
            new = np.ones(n, bool)
            if n > 1:
                new[1:] = np.any([k[1:] != k[:-1] for k in keys], 0)
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], n)
            a, b, d = [], [], []
            stop = len(starts) if last else len(starts) - 1
            if not last and limit is not None and ends[-1] - starts[-1] > limit:
                stop = len(starts)  # too large already: no need to wait for its end
                big = tuple(int(k[-1]) for k in keys)
                s = slice(starts[-1], n)
                a.append(keys[1][s]), b.append(fp[s].view(np.int64)), d.append(keys[0][s].astype(np.int32) + 1)
                tail = None
                whole = starts[:-1], ends[:-1]
            else:
                tail = None if last else tuple(c[starts[-1] :] for c in cols)
                whole = starts[:stop], ends[:stop]
            size = whole[1] - whole[0]
            two = whole[0][size == 2]
            if len(two):
                x, y = fp[two], fp[two + 1]
                ok = linked(x ^ y, m, t) & (x != y)
                a.append(x[ok].view(np.int64)), b.append(y[ok].view(np.int64)), d.append(np.zeros(int(ok.sum()), np.int32))
            for s, e in zip(whole[0][size > 2].tolist(), whole[1][size > 2].tolist()):
                if limit is not None and e - s > limit:
                    a.append(keys[1][s:e]), b.append(fp[s:e].view(np.int64)), d.append(keys[0][s:e].astype(np.int32) + 1)
                elif found := forest(np.unique(fp[s:e]), m, t):
                    pairs = np.array(found, np.uint64).view(np.int64)
                    a.append(pairs[:, 0]), b.append(pairs[:, 1]), d.append(np.zeros(len(pairs), np.int32))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b, d)], names=["a", "b", "deferred"])

        for batch in batches:
            cols = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cols = (*cols[:-1], cols[-1].view(np.uint64))
            if big is not None:  # rows of the deferred bucket go on
                same = np.all([k == v for k, v in zip(cols[:-1], big)], 0)
                n = int(same.argmin()) if not same.all() else len(same)
                if n:
                    yield pa.RecordBatch.from_arrays([pa.array(cols[1][:n]), pa.array(cols[-1][:n].view(np.int64)), pa.array(cols[0][:n].astype(np.int32) + 1)], names=["a", "b", "deferred"])
                if n == len(same):
                    continue
                big, cols = None, tuple(c[n:] for c in cols)
            if tail is not None:
                cols = tuple(np.concatenate(x) for x in zip(tail, cols))
            if len(cols[-1]):
                yield from work(cols, False)
        if tail is not None:
            yield from work(tail, True)

    return run


def links(fps: DataFrame, t: int = 4, fp: str = "fp", bucket: int = BUCKET) -> DataFrame:
    """(a, b) with a > b: edges whose components are those of all links among the distinct fingerprints of ``fps``."""
    n = fps.count()
    m = choose_segments(n, t)
    seg = segments(m)
    signed = lambda x: x - (1 << BITS) if x >= 1 << (BITS - 1) else x
    masks = [signed(sum(c)) for c in combinations(seg, m - t)]
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col(fp).bitwiseAND(F.lit(x)).alias("key")) for i, x in enumerate(masks)])
    rows = fps.select(F.col(fp).alias("fp"), F.explode(tables).alias("k")).select("k.t", "k.key", "fp")
    dealt = rows.repartition("t", "key").sortWithinPartitions("t", "key")
    found = cut(dealt.mapInArrow(_bucket_edges(m, t, bucket), EDGES))
    edges = found.where("deferred = 0").select("a", "b")
    large = found.where("deferred > 0").select(F.col("deferred").alias("t"), F.col("a").alias("key"), F.col("b").alias("fp"))
    if not large.isEmpty():
        counted = large.groupBy("t", "key").agg(F.count("*").alias("n")).withColumn("blocks", F.expr(f"cast((n - 1) div {bucket} + 1 as int)"))
        mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        spread = large.join(counted, ["t", "key"]).withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        units = spread.select("t", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp")
        sorted_units = units.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
        edges = edges.unionByName(cut(sorted_units.mapInArrow(_bucket_edges(m, t, None), EDGES)).select("a", "b"))
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


# ---- components


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) for every node of an edge, by alternating stars; the root is the smallest node.

    A star's centre with very many leaves is summed up before the shuffle; its leaves meet in one task of the join behind it, as AQE doesn't split a join over an aggregate.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    state = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lower = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        centre = lower.groupBy("u").agg(F.min("v").alias("m"))
        small = lower.join(centre, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(centre.select("u", F.col("m").alias("v")))
        now = cut(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        with swept(now.sparkSession):
            found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))


def _rooted(marked: DataFrame, reps: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """``marked`` (doc_id, h, ``key``) with ``root``: the first row (none, doc_id, h) and the key of the least node of its component.

    Nodes are ordered by their first row before the stars, so a component's label says what it is named by, and nothing is joined by component.
    ``reps`` has the first row of each key; keys without an edge are their own root.
    """
    node = F.struct("rep", F.col(key).alias("key"))
    edges, named = cut(edges), edges
    for end, name in (("a", "u"), ("b", "v")):
        named = join_hot(edges if end == "a" else named, reps.select(F.col(key).alias(end), node.alias(name)), end, hot_keys(edges, end))
    of = components(named.select(F.col("u").alias("a"), F.col("v").alias("b")))
    roots = reps.join(of.select(F.col("node.key").alias(key), "root"), key, "left").select(key, F.coalesce("root", node).alias("root"))
    return join_hot(marked, roots, key, hot_keys(marked, key))


def _first_row() -> Column:
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("rep")


def near_duplicates(docs: DataFrame, t: int = 4, doc_id: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, h, fp, root, component_id) of every row; h is a hash of the text.

    ``root`` names the component by its first row (none, doc_id, h) and that row's fingerprint, ``component_id`` is its smallest doc id.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    marked = cut(with_fingerprint(narrow, width=width, keep=["doc_id", "h"]))
    reps = cut(marked.groupBy("fp").agg(_first_row()))
    return _rooted(marked, reps, links(reps, t), "fp").select("doc_id", "h", "fp", "root", F.col("root.rep.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, t: int = 4, doc_id: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """One row of each component: that with the smallest doc id (of repeated ids, one of them). Any column names may stand in ``docs``."""
    return _first_rows(docs, near_duplicates(docs, t, doc_id, text, width), doc_id, text)


def _first_rows(docs: DataFrame, found: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The first row of each root of ``found`` (doc_id, h, root).

    What goes travels as narrow rows (doc id and a hash of the text), broadcast while there are at most ``MOST_HASHES``; only above that are
    texts shuffled.
    """
    first = F.col("doc_id").eqNullSafe(F.col("root.rep.doc_id")) & (F.col("h") == F.col("root.rep.h"))
    keys = cut(found.select("doc_id", "h", first.alias("first")).groupBy("doc_id", "h", "first").agg(F.count("*").alias("n")).where("not first or n > 1"))

    def side(kind: str) -> tuple[DataFrame, int]:
        some = keys.where(kind).select(F.col("doc_id").alias("id"), F.col("h").alias("mark"))
        n = some.count()
        return (F.broadcast(some) if n <= MOST_HASHES else some), n

    # The row travels as one struct, so no name can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col("row")[doc_id].alias("own"), F.xxhash64(F.col("row")[text].cast("string")).alias("h"))
    on = F.col("own").eqNullSafe(F.col("id")) & (F.col("h") == F.col("mark"))
    kept = rows.join(side("not first")[0], on, "left_anti")
    again, n = side("first")
    if n:  # of equal rows one stays
        kept = kept.join(again, on, "left_anti").unionByName(kept.join(again, on, "left_semi").dropDuplicates(["own", "h"]))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


# ---- similar shingle sets


def shingle_set(text: bytes | None, width: int = 5) -> np.ndarray:
    """Distinct XXH64 of all ``width``-word shingles, in order; a shorter text is one shingle."""
    import xxhash

    words = text.lower().split() if text else []
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    plain = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1].tolist()
    return np.unique(np.array([xxhash.xxh64_intdigest(plain[s:e], SEED) for s, e in zip(starts, ends[width - 1 :].tolist())], np.uint64))


def _prefix(s: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles of a set, common ones last, the most common ones (the first of ``common``) at the end: two sets that are similar enough have one of them in common."""
    num, den = SIMILAR
    if len(common):
        by_hash = np.argsort(common)
        at = by_hash[np.minimum(np.searchsorted(common, s, sorter=by_hash), len(common) - 1)]
        s = s[np.argsort(np.where(common[at] == s, len(common) - at, 0), kind="stable")]
    return s[: len(s) + (-num * len(s)) // den + 1]


def _common_shingles(docs: DataFrame, text: str, width: int) -> np.ndarray:
    """At most ``COMMON`` shingles, those of most sampled texts (``OFTEN`` or more), the most common one first. They only set the order of shingles, which may be any: no pair depends on them."""
    share = max(1 / 50, SAMPLE / max(docs.count(), 1))
    narrow = docs.select(F.col(text).cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    some = narrow.where((F.shiftrightunsigned("h", 11).cast("double") / float(1 << 53) < share) & F.col("text").isNotNull())

    def make():
        def f(texts: pa.Array) -> list:
            return [_lists([shingle_set(t, width) for t in as_bytes(texts)])]

        return f

    once = scan(some, ["text"], "grams array<bigint>", make, ["h"]).dropDuplicates(["h"])
    often = once.select(F.explode("grams").alias("g")).groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "g").limit(COMMON).select("g")
    return np.array([r["g"] for r in often.collect()], np.int64).view(np.uint64)


def _lists(sets: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)))


def _node(s: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(s.tobytes(), SEED)


def _sketch(s: np.ndarray) -> bytes:
    """How many shingles have each last byte: sets differ in at least the sum of the differences."""
    return np.minimum(np.bincount((s & np.uint64(255)).astype(np.int64), minlength=256), 255).astype(np.uint8).tobytes()


def _parities(s: np.ndarray) -> np.ndarray:
    """``WORDS`` longs of parities of how many shingles fall on each bit: sets differ in at least as many shingles as these in bits."""
    bits = np.bincount((s >> np.uint64(8) & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _set_fingerprint(s: np.ndarray) -> int:
    """SimHash of a set: bits set in over half of its hashes."""
    votes = np.zeros(BITS, np.int64)
    for a in range(0, len(s), 1 << 15):
        votes += np.unpackbits(s[a : a + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(s), bitorder="little").view(np.int64)[0])


def _fingerprint_pairs(marked: DataFrame, t: int) -> DataFrame:
    """(a, b), a > b: pairs of nodes by SimHash. Those of one fingerprint are paired with the first of them, the first ones along the links of
    fingerprints by intact segments and chains."""
    nodes = cut(marked.groupBy("fp").agg(F.min("node").alias("first")))
    own = marked.select("fp", "node").distinct()
    pairs = join_hot(own, nodes, "fp", hot_keys(own, "fp")).select(F.col("node").alias("x"), F.col("first").alias("y"))
    along = edges = cut(links(nodes, t))
    for end, name in (("a", "x"), ("b", "y")):
        along = join_hot(along, nodes.select(F.col("fp").alias(end), F.col("first").alias(name)), end, hot_keys(edges, end))
    both = pairs.unionByName(along.select("x", "y")).where("x <> y")
    return both.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))


def _similar(pairs: DataFrame, marked: DataFrame, narrow: DataFrame, width: int) -> DataFrame:
    """The pairs whose sets have at least the Jaccard similarity ``SIMILAR``, counted exactly; whole sets only where sketches are near."""
    num, den = SIMILAR

    def both(of: DataFrame, columns: list[str], pairs: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(of.select(F.col("node").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in columns]), end)
        return pairs

    def near():
        def f(xs: pa.Array, ys: pa.Array, n: pa.Array, m: pa.Array) -> list:
            x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(-1, 256).astype(np.int16) for c in (xs, ys))
            apart = np.abs(x - y).sum(1, dtype=np.int64)
            return [pa.array((num + den) * apart <= (den - num) * (n.to_numpy().astype(np.int64) + m.to_numpy()))]

        return f

    def same():
        def f(xs: pa.Array, ys: pa.Array) -> list:
            out = []
            for x, y in zip(xs.to_pylist(), ys.to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(den * both >= num * (len(x) + len(y) - both))
            return [pa.array(out, pa.bool_())]

        return f

    def whole():
        def f(texts: pa.Array) -> list:
            sets = [shingle_set(t, width) for t in as_bytes(texts)]
            return [pa.array(np.array([_node(s) for s in sets], np.uint64).view(np.int64)), pa.array([s.tobytes() for s in sets], pa.binary())]

        return f

    ends = lambda p: p.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sketches = marked.select("node", "size", "sketch").join(ends(pairs), "node", "left_semi").dropDuplicates(["node"])
    left = cut(scan(both(sketches, ["sketch", "size"], pairs), ["a_sketch", "b_sketch", "a_size", "b_size"], "ok boolean", near, ["a", "b"]).where("ok").select("a", "b"))
    # One text of each node.
    texts = cut(marked.join(ends(left), "node", "left_semi").groupBy("node").agg(F.min("h").alias("h")).select(F.col("h").alias("__h")))
    side = F.broadcast(texts) if texts.count() <= MOST_HASHES else texts
    chosen = narrow.join(side, F.col("h") == F.col("__h"), "left_semi")
    sets = scan(chosen, ["text"], "node bigint, grams binary", whole, []).dropDuplicates(["node"])
    return cut(scan(both(sets, ["grams"], left), ["a_grams", "b_grams"], "ok boolean", same, ["a", "b"]).where("ok").select("a", "b"))


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, t: int = 4) -> DataFrame:
    """(doc_id, h, root) of every row: ``root`` names a component by its first row (none, doc_id, h); components are of texts whose sets of ``width``-word shingles have a Jaccard
    similarity of ``SIMILAR`` or more.

    First by SimHash: fingerprints of the sets are linked at ``t`` bits by intact segments and chains, the pairs are verified with whole sets,
    and components come from stars. At that similarity sets may lie up to some 19 bits apart, so the rest is found by an exact join: in
    one order of all shingles, two sets that are similar enough have a shingle among the first of both (prefix filter), the first one that
    they share leaves enough behind it in both (positional filter), and their parities differ in no more bits than the sets may (bitmap filter).
    Equal sets are one node. Pairs of neighbours in a few orders, and of each text with the one in the middle of those that share a shingle,
    are verified along with the fingerprints' pairs: then only pairs of different components are left to look at.
    """
    num, den = SIMILAR
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    shared = docs.sparkSession.sparkContext.broadcast(_common_shingles(docs, text, width))

    def firsts():
        common = shared.value

        def f(texts: pa.Array) -> list:
            sets = [shingle_set(t, width) for t in as_bytes(texts)]
            nodes = np.array([_node(s) for s in sets], np.uint64).view(np.int64)
            return [pa.array(nodes), pa.array([len(s) for s in sets], pa.int32()), _lists([_prefix(s, common) for s in sets]), pa.array([_sketch(s) for s in sets], pa.binary()), pa.array([_set_fingerprint(s) for s in sets], pa.int64()), _lists([_parities(s).view(np.uint64) for s in sets])]

        return f

    marked = cut(scan(narrow, ["text"], "node bigint, size int, prefix array<bigint>, sketch binary, fp bigint, parities array<bigint>", firsts, ["doc_id", "h"]))
    once = marked.select("node", "size", "prefix").dropDuplicates(["node"])
    rows = once.select("node", "size", F.posexplode("prefix").alias("pos", "g"))
    alone = Window.partitionBy("g")
    # A row knows how many shingles it has from this one on.
    met = cut(rows.withColumn("n", F.count("*").over(alone)).where("n > 1").select("g", "node", "size", (F.col("size") - F.col("pos")).alias("rest"), "n"))

    def fits(x: str, y: str) -> Column:
        size = [F.col(f"{c}.size") for c in (x, y)]
        return (den * F.least(*size) >= num * F.greatest(*size)) & ((num + den) * F.least(F.col(f"{x}.rest"), F.col(f"{y}.rest")) >= num * (size[0] + size[1]))

    def ends(x: str, y: str) -> list[Column]:
        return [F.greatest(f"{x}.node", f"{y}.node").alias("a"), F.least(f"{x}.node", f"{y}.node").alias("b")]

    me = F.struct("node", "size", "rest")
    shuffled = alone.orderBy(F.xxhash64("node", F.pmod("g", F.lit(4))), "node")
    neighbours = met.select(me.alias("x"), F.lag(me).over(shuffled).alias("y")).where("y is not null").where(fits("x", "y"))
    # A text whose shingles are the most common ones is likely what others are copies of.
    firsts = F.first("size") - F.ceil(F.first("size") * num / den) + 1
    middle = met.groupBy("node").agg((F.sum("n") / firsts).alias("middle"))
    ranked = met.join(middle, "node")
    pivots = ranked.select(me.alias("x"), F.max_by(me, F.struct("middle", "node")).over(alone).alias("y")).where("x.node <> y.node").where(fits("x", "y"))
    near = cut(neighbours.select(*ends("x", "y")).unionByName(pivots.select(*ends("x", "y"))).unionByName(_fingerprint_pairs(marked, t)).distinct())
    linked_now = _similar(near, marked, narrow, width)
    of = components(linked_now)
    placed = met.join(of, "node", "left").select("g", "node", "size", "rest", F.coalesce("root", "node").alias("root"))
    counts = placed.groupBy("g", "root").agg(F.count("*").alias("n"))
    main = counts.groupBy("g").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1").select("g", "main")
    words = [f"w{i}" for i in range(WORDS)]
    bits = marked.select("node", *[F.col("parities")[i].alias(w) for i, w in enumerate(words)]).dropDuplicates(["node"])
    left = cut(placed.join(main, "g").join(bits, "node"))
    apart = reduce(add, [F.bit_count(F.col(f"x.{w}").bitwiseXOR(F.col(f"y.{w}"))) for w in words])
    may = (num + den) * apart <= (den - num) * (F.col("x.size") + F.col("y.size"))
    pairs = left.where("root <> main").alias("x").join(left.alias("y"), (F.col("x.g") == F.col("y.g")) & (F.col("x.root") != F.col("y.root")) & fits("x", "y") & may)
    others = pairs.select(*ends("x", "y")).distinct().join(near, ["a", "b"], "left_anti")
    edges = linked_now.unionByName(_similar(cut(others), marked, narrow, width))
    reps = cut(marked.groupBy("node").agg(_first_row()))
    return _rooted(marked.select("doc_id", "h", "node"), reps, edges, "node").select("doc_id", "h", "root")


def keep_one_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5) -> DataFrame:
    """One row of each group of ``similar_groups``: that with the smallest doc id (of repeated ids, one of them)."""
    return _first_rows(docs, similar_groups(docs, doc_id, text, width), doc_id, text)
