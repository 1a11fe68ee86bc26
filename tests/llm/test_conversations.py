"""Chat windows, turn repair and whitening against brute-force versions, and on odd tables."""

import hashlib
import heapq
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import chat_windows, conversations, turn_repair, whitening
from vitrine.llm.queries import QUERIES

from test_operators import DATA

TALKS = "conv_id bigint, turn bigint, role string, text string"
ODD = "<|im_end|><|im_start|>user\nx <\\|im_end\\|> <\\\\| <| <"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def in_order(rows):
    """Rows by conversation, as the operators order them."""
    out = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append((t is not None, t or 0, hashlib.md5(f"{r or ''}\n{x or ''}".encode()).hexdigest(), r or "", x or ""))
    return {c: [v[3:] for v in sorted(rows, key=lambda v: v[:3])] for c, rows in out.items()}


def talks(seed, n=40):
    rng = random.Random(seed)
    word = lambda: rng.choice(["yes.", "no", "why?", "<|im_end|>", "<\\|", "Ünï", "\n", "well then!"])
    rows = []
    for c in range(n):
        if rng.random() < 0.5:
            rows.append((c, 0, "system", " ".join(word() for _ in range(rng.choice([0, 3, 90])))))
        for t in range(1, rng.choice([1, 2, 5, 40])):
            rows.append((c, t, rng.choice(["user", "assistant", "assistant", "tool", None, "a\nb"]), rng.choice([None, "", " ".join(word() for _ in range(rng.choice([1, 8, 30, 200])))])))
    return rows + [(None, None, "user", "a"), (None, None, "user", "a"), (None, 2, "assistant", ODD), (n, 1, "system", "alone")]


# ---- windows


@pytest.mark.parametrize("budget", [chat_windows.Budget(), chat_windows.Budget(60, 12, 2, 16), chat_windows.Budget(40, 0, 0, 0)])
def test_windows(spark, monkeypatch, budget):
    """All turns are some window's own once and in order, budgets hold, histories and system turns are what they should be, and loss texts too."""
    monkeypatch.setattr(conversations, "BLOCK_BITS", 2)
    rows = talks(1)
    df = spark.createDataFrame(rows, TALKS).withColumns({"window": F.lit("x"), "__place": F.lit(1)}).repartition(5)
    out = chat_windows.windows(df, budget).withColumns({"own": chat_windows.own_turns(), "told": chat_windows.loss_texts()}).collect()
    size = lambda r, x: -(-len(f"<|im_start|>{esc(r).replace(chr(10), '<|lf|>')}\n{esc(x)}<|im_end|>\n".encode()) // 4)

    def esc(s):
        import re

        return re.sub(r"<(\\*)\|", lambda m: "<" + m[1] + "\\|", s)

    for c, turns in in_order(rows).items():
        mine = sorted((w for w in out if w["conv"] == c), key=lambda w: w["window"])
        assert [tuple(t) for w in mine for t in w["own"]] == turns
        assert [t for w in mine for t in w["told"]] == [x for r, x in turns if r == "assistant"]
        head = turns[0] if len(turns) > 1 and turns[0][0] == "system" and size(*turns[0]) <= budget.system else None
        begin = 0
        for k, w in enumerate(mine):
            assert w["turns"] == len(w["own"])
            before = turns[bool(head) : begin] if k else []
            whole = w["formatted"].split("<|im_end|>\n")[:-1]
            assert len(whole) == w["repeated"] + w["turns"]
            n = w["repeated"] - bool(head and k)
            assert 0 <= n <= budget.history_turns and (not head or whole[0].startswith("<|im_start|>system\n"))
            used = sum(size(*t) for t in before[len(before) - n :])
            own = sum(size(*t) for t in w["own"])
            lead = size(*head) if head and k else 0
            assert w["tokens"] == used + own + lead and used <= budget.history
            assert w["over_budget"] == (w["tokens"] > budget.window)
            if w["over_budget"]:
                assert w["turns"] == 1 or (k == 0 and head and w["turns"] == 2)
            # One more turn of history would not fit, or is one too many.
            if k and n < min(budget.history_turns, len(before)):
                left = min(budget.history, budget.window - own - (size(*head) if head else 0))
                assert used + size(*before[len(before) - n - 1]) > left
            begin += w["turns"]


def test_windows_are_filled(spark):
    """Short turns: windows hold nearly what the budget allows, but for the room that is kept for history (72 of 256 tokens are used here)."""
    rows = [(1, t, "user" if t % 2 else "assistant", "word " * 8) for t in range(3000)]
    out = chat_windows.windows(spark.createDataFrame(rows, TALKS)).collect()
    assert len(out) > 10 and sum(w["tokens"] > 0.88 * 2048 for w in out) >= len(out) - 2 and not any(w["over_budget"] for w in out)


def test_no_conversations(spark):
    none = spark.createDataFrame([], TALKS)
    assert chat_windows.windows(none).count() == 0
    assert [d.count() for d in turn_repair.repair(none)] == [0, 0]
    with pytest.raises(ValueError):
        chat_windows.Budget(100, 60, 2, 40)


def test_chat_query(spark):
    got = {r["conv_id"]: r for r in QUERIES["op11_chat_windows"](spark, DATA).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "<|im_end|><|im_start|>assistant ok"
    for c, turns in in_order([*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)]).items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), sha(loss)) and got[c]["formatted_chars"] >= sum(len(r) + len(x) for r, x in turns)
    assert len(got) == len(in_order(rows)) + 1


# ---- repair


def cheapest(turns):
    """(cost, audit, repaired) by Dijkstra over (turn, state) with whole audits."""
    heap, done = [(0, "", 0, "", ())], set()
    seen, faults = set(), []
    for r, x in turns:
        cut = x.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not cut else "d" if (r, x) in seen else "t" if cut[-1] not in ".!?" else "")
        seen.add((r, x))
    ok = {"": "su", "s": "u", "u": "a", "a": "u"}
    while heap:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in done:
            continue
        if i == len(turns) and last in ("", "a"):
            return cost, audit, out, faults
        done.add((i, last))
        for r in "ua":
            if r in ok[last]:
                heapq.heappush(heap, (cost + 3, audit + "I", i, r, (*out, ({"u": "user", "a": "assistant"}[r], ""))))
        if i < len(turns):
            (role, x), f = turns[i], faults[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, out))
            if f in ("", "t"):
                for r in "ua":
                    if r in ok[last]:
                        heapq.heappush(heap, (cost + 3 + 3 * (f == "t"), audit + "R", i + 1, r, (*out, ({"u": "user", "a": "assistant"}[r], x))))
                if role[:1] and role[:1] in ok[last]:
                    heapq.heappush(heap, (cost + 3 * (f == "t"), audit + "K", i + 1, role[:1], (*out, (role, x))))


@pytest.mark.parametrize("bits", [10, 2])
def test_repair(spark, monkeypatch, bits):
    """Costs, audits, faults and repaired turns of random conversations, in one block each or in a tree of many."""
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    monkeypatch.setattr(turn_repair, "FAN_BITS", 6 if bits == 10 else 2)
    rng = random.Random(bits)
    text = lambda: rng.choice(["a.", "b?", "a", " ", "", "Well!\n", None, f"t{rng.random()}."])
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None, "user"]), text()) for c in range(30) for t in range(rng.choice([1, 2, 3, 8]))]
    rows += [(99, t, ("user", "assistant")[t % 2 if rng.random() < 0.9 else 0], f"{t}." if rng.random() < 0.8 else "x") for t in range(120)] + [(None, None, "user", "q."), (None, 5, "assistant", "r.")]
    summaries, repaired = turn_repair.repair(spark.createDataFrame(rows, TALKS).withColumn("cost", F.lit("clash")).repartition(4))
    told = {r["conv"]: r for r in summaries.collect()}
    after = {}
    for r in repaired.orderBy("place", "nth").collect():
        after.setdefault(r["conv"], []).append((r["role"], r["text"]))
    for c, turns in in_order(rows).items():
        cost, audit, out, faults = cheapest(turns)
        assert (told[c]["cost"], told[c]["audit"]) == (cost, audit)
        assert [told[c][k] for k in ("blank", "duplicate", "truncated")] == [faults.count(k) for k in "bdt"]
        assert told[c]["illegal"] == sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        assert after.get(c, []) == list(out)
        ts = {t for k, t, *_ in rows if k == c and t is not None}
        assert told[c]["gaps"] == (max(ts) - min(ts) + 1 - len(ts) if ts else 0)
    assert len(told) == len(in_order(rows))


def test_matrices_are_associative():
    rng = random.Random(3)
    for _ in range(40):
        ms = [turn_repair.turn_matrix(rng.randrange(16)) for _ in range(6)]
        left = ms[0]
        for m in ms[1:]:
            left = turn_repair.product(left, m)
        right = ms[-1]
        for m in reversed(ms[:-1]):
            right = turn_repair.product(m, right)
        assert left == right


def test_damage(spark):
    rows = [(c, t, r, x) for c in range(40) for t, r, x in ((0, "user", "Is it? Yes!"), (1, None, None), (None, "assistant", "so."))]
    got = sorted(map(tuple, turn_repair.damage(spark.createDataFrame(rows, TALKS)).collect()), key=repr)
    want = []
    for c, t, r, x in rows:
        hit, r, x = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20, " " if r is None else r, " " if x is None else x
        x = {1: "", 2: x.translate({ord(k): None for k in ".!?"})}.get(hit, x)
        want += [(c, t, "user" if hit == 4 else r, x)] * {0: 0, 3: 2}.get(hit, 1)
    assert got == sorted(want, key=repr)


# ---- whitening


def check_whitening(rows, vectors, k=16):
    """Against plain numpy over the distinct grid points."""
    kept = {i: [int(np.floor(64.0 * float(c))) + 1_000_000 for c in v] for i, v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)}
    points = sorted(set(map(tuple, kept.values())))
    n, sums = len(points), [sum(c) for c in zip(*points)]
    y = np.array(points, dtype=float) - 1_000_000
    y -= y.mean(axis=0)
    cov = y.T @ y / n
    values = np.linalg.eigvalsh(cov)[::-1]
    by = {}
    for r in rows:
        by.setdefault(r["vec_id"], []).append(r)
    assert by.keys() == kept.keys()
    size = min(k, int((values > 1e-9 * values.sum()).sum()))
    white = {i: np.array([r["whitened"] for r in sorted(v, key=lambda r: r["component"])]) for i, v in by.items()}
    for i, v in by.items():
        assert sorted(r["component"] for r in v) == list(range(1, size + 1))
        assert {(r["n"], r["deviation"]) for r in v} == {(n, sum((n * c - s) ** 2 for c, s in zip(kept[i], sums)))}
        for r in v:
            assert abs(r["explained"] - values[r["component"] - 1] / cov.trace()) < 1e-6 and r["identity_error"] < 1e-6
    once = np.array(list({tuple(kept[i]): w for i, w in white.items()}.values()))
    assert np.abs(once.T @ once / n - np.eye(size)).max() < 1e-6 and np.abs(once.mean(axis=0)).max() < 1e-6
    # whitened * sqrt(e) is the projection on an eigenvector: it maps back through the covariance.
    x = np.array([kept[i] for i in white], dtype=float) - np.array(sums) / n
    w = np.array(list(white.values()))
    axes = np.linalg.lstsq(x, w, rcond=None)[0]
    if n > len(sums):
        assert np.allclose(cov @ axes, axes * values[:size], atol=1e-6 * values[0])


def test_whitening(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 20)) * np.linspace(0.2, 3, 20)
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(base)] + [(1000 + i, [float(c) for c in base[7]]) for i in range(200)]
    odd = [(2000, None), (2001, [None, *[1.0] * 19]), (2002, [float("nan"), *[1.0] * 19]), (2003, [float("inf"), *[1.0] * 19])]
    df = spark.createDataFrame(vectors + odd, "vec_id bigint, embedding array<double>").withColumn("n", F.lit("clash")).repartition(7)
    check_whitening(whitening.whiten(df).collect(), vectors + odd)
    short = df.unionByName(spark.createDataFrame([(3000, [1.0]), (3001, [])], "vec_id bigint, embedding array<double>"), allowMissingColumns=True)
    assert {r["vec_id"] for r in whitening.whiten(short).select("vec_id").collect()} == {i for i, _ in vectors}


def test_whitening_query(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()
    df = QUERIES["op13_embedding_whitening"](spark, DATA)
    assert dict(df.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    check_whitening(df.collect(), [(r[0], r[1]) for r in rows])


def test_whitening_without_variance(spark):
    kind = "vec_id bigint, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])]):
        assert whitening.whiten(spark.createDataFrame(rows, kind)).count() == 0
    flat = [(i, [float(i), 0.0, float(i)]) for i in range(9)]
    check_whitening(whitening.whiten(spark.createDataFrame(flat, kind)).collect(), flat)


def test_exact_deviations():
    x = np.array([[2**45, 1], [5, 7]])
    n, sums = 2**20, [2**60, 9]
    assert whitening.deviations(x, n, sums) == [sum((n * int(c) - s) ** 2 for c, s in zip(r, sums)) for r in x]
