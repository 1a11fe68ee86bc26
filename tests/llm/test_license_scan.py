"""Spans of the license scan against a plain Python aligner, and every column of its query."""

import random
from collections import defaultdict

import pytest

from vitrine.llm import license_scan
from vitrine.llm.license_scan import NOTICES, PHRASES, TEXTS
from vitrine.llm.queries import QUERIES

from test_operators import DATA, ODD, ascii_words

ALL = PHRASES + NOTICES + TEXTS


def best_chain(hits, n_words, k=2):
    """(score, k-grams, minus span, minus first) of the best chain through hits (at, pos)."""
    ends = []
    for at, pos in sorted(hits):
        longer = [
            (c[0] + min(at - c[4], k), c[1] + 1, c[2], pos, at)
            for c in ends
            if (0 < at - c[4] < k and pos - c[3] >= at - c[4]) or (at - c[4] >= k and pos - c[3] >= k)
        ]
        ends.append(max(longer, default=(k, 1, pos, pos, at)))
    return max((w / (n_words + max(0, last + k - first - w)), grams, first - last, -first) for w, grams, first, last, _ in ends)


def align(text, templates=ALL, gap=3, k=2):
    """(label, template, first, end, score) of one text."""
    words, out = ascii_words(text), []
    pairs = defaultdict(list)
    for i in range(len(words) - 1):
        pairs[words[i], words[i + 1]].append(i)
    for number, t in enumerate(templates):
        own = t.text.split()
        diagonals = defaultdict(list)
        for j in range(len(own) - 1):
            for i in pairs.get((own[j], own[j + 1]), ()):
                diagonals[i - j].append((j, i))
        good = {}
        for d in sorted(diagonals):
            if t.share >= 1:
                if len(diagonals[d]) == len(own) - 1:
                    good[d] = (1.0, len(own) - 1, 2 - len(own), -d)
                continue
            band = [h for x in range(d, d + gap + 1) for h in diagonals.get(x, ())]
            if len(band) >= t.share * (len(own) - 1):
                best = best_chain(band, len(own))
                if best[1] >= t.share * (len(own) - 1) and best[0] >= t.share:
                    good[d] = best
        runs, last = [], None
        for d in sorted(good):
            if last is None or d - last > (0 if t.share >= 1 else gap):
                runs.append([])
            runs[-1].append(good[d])
            last = d
        out += [(t.label, number, -b[3], -b[3] - b[2] + k, b[0]) for b in map(max, runs)]
    return sorted(out)


def spans_of(spark, texts, templates=ALL):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    rows = {r["doc_id"]: (r["n_words"], [tuple(s) for s in r["spans"]]) for r in license_scan.scan_licenses(df, templates).collect()}
    assert len(rows) == len(texts)
    return [rows[i] for i in range(len(texts))]


@pytest.mark.parametrize("most", [200_000, 0])
def test_spans_equal_the_aligner(spark, monkeypatch, most):
    """Random edits of templates, mixed with their most common words; broadcast and shuffled."""
    monkeypatch.setattr(license_scan, "BROADCAST_GRAMS", most)
    rng = random.Random(4)
    words = "the of and to this software license under licensed in or is any by cc 4 0 mit x y".split()
    texts = [t for t in ODD if len(t or "") < 9000]
    for _ in range(250):
        parts = []
        for _ in range(rng.randint(1, 3)):
            t = rng.choice(ALL).text.split()
            for _ in range(rng.randint(0, max(1, len(t) // 6))):
                i = rng.randrange(len(t))
                if rng.random() < 0.5:
                    t.insert(i, rng.choice(words))
                elif len(t) > 2:
                    del t[i]
            parts += t + [rng.choice(words) for _ in range(rng.randint(0, 8))]
        texts.append(" ".join(parts))
    got = spans_of(spark, texts)
    for t, (n, spans) in zip(texts, got):
        want = align(t)
        assert n == len(ascii_words(t)) and [s[:4] for s in spans] == [w[:4] for w in want], t
        assert all(abs(s[4] - w[4]) < 1e-12 for s, w in zip(spans, want))
    assert sum(len(s) for _, s in got) > 200


def test_far_pieces_are_no_notice(spark):
    """Pieces of a notice that drift apart, or stand far from each other, give no label; whole texts and edited ones do."""
    mit = TEXTS[0].text.split()
    texts = ["released under " + "x under the " * 300 + "the mit license", "released under x x under the x x the mit", " ".join(mit), " ".join(w for i, w in enumerate(mit) if i % 15), " ".join(mit[:90]), "word " * 200_000 + "released under the mit license"]
    got = [{s[0] for s in spans if s[1] >= len(PHRASES)} for _, spans in spans_of(spark, texts)]
    assert got == [set(), set(), {"mit"}, {"mit"}, {"mit"}, {"mit"}]
    whole = spans_of(spark, texts[2:3])[0][1]
    assert (len(PHRASES + NOTICES), 0, len(mit), 1.0) in [s[1:] for s in whole]


def test_query_rows(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    df = QUERIES["op9_license_scan"](spark, DATA)
    assert dict(df.dtypes) == {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"}
    rows = df.collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans = align(docs[r["doc_id"]])
        base = sorted(s[2] for s in spans if s[1] < len(PHRASES))
        labels = lambda some: ",".join(sorted({s[0] for s in some}))
        assert (r["n_words"], r["n_base"]) == (len(ascii_words(docs[r["doc_id"]])), len(base))
        assert (r["first_word"], r["last_word"]) == ((base[0], base[-1]) if base else (None, None))
        assert (r["base_labels"], r["labels"]) == (labels(s for s in spans if s[1] < len(PHRASES)), labels(spans))
        assert abs(r["score"] - max((s[4] for s in spans), default=0.0)) < 1e-12
