"""All columns of the queries without SQL, recomputed in plain Python, and the pipeline on odd tables."""

import math
import zlib

import numpy as np
import pytest
import xxhash

from vitrine.llm import decontamination, language_id, quality_rules, sharding, token_counts
from vitrine.llm.queries import QUERIES, SHARDS, vocabulary

from test_operators import DATA, brute_statistics


@pytest.fixture(scope="module")
def table(spark):
    return {r["doc_id"]: r.asDict() for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def descend(tree, key):
    """The shard of a key by the draws of each level."""
    node, children = "", tree.children()
    while node in children:
        # xxHash64 of the key, seeded with 42, seeds the hash of the child's name.
        h = [(xxhash.xxh64_intdigest(n.encode(), xxhash.xxh64_intdigest(key.encode(), 42)), n, w) for n, w in children[node]]
        node = min((-math.log(((x >> 11) + 0.5) / (1 << 53)) / w, n) for x, n, w in h)[1]
    return int(node)


def test_sharding_rows(spark, table):
    df = QUERIES["op2_sharding"](spark, DATA)
    assert dict(df.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    rows, slots = df.collect(), {}
    assert sorted(r["doc_id"] for r in rows) == sorted(table)
    for r in rows:
        raw = (table[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert r["shard"] == descend(SHARDS, str(r["doc_id"])) and r["grown_shard"] == descend(SHARDS.grow(), str(r["doc_id"]))
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_sharding_of_long_texts(spark):
    df = spark.createDataFrame([(1, "é" * 2_000_000), (2, ""), (None, None)], "doc_id bigint, text string")
    assert {(r["doc_id"], r["size"]) for r in sharding.place(df, sharding.Topology.even(1, 1, 2)).collect()} == {(1, 4_000_016), (2, 16), (None, 16)}


def test_token_count_rows(spark, table):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    df = QUERIES["op4_token_counts"](spark, DATA)
    assert dict(df.dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    for r in df.collect():
        text = table[r["doc_id"]]["text"] or ""
        n = len(own.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 512)


@pytest.mark.parametrize("text", ["word\n" * 4000, "word\t" * 4000, "it's,we'll;don't!" * 1500, "a.b:c?d " * 1500, "x \n y" * 3000, "<|endoftext|>a. <|endoftext|>" * 800, "é!ü,\x1c.\x1c,a,\x85b" * 900])
def test_splits_are_safe(text):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    lengths, splits = token_counts.load_counter(vocabulary("byte_bpe_50k.json"))
    pieces = list(token_counts.split_text(text, 100))
    assert splits and "".join(pieces) == text and (len(pieces) > 10 or "x \n y" in text)
    assert sum(lengths(pieces)) == len(own.encode(text, add_special_tokens=False).ids)


def test_token_counts_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_counts.count_tokens(none, vocabulary("byte_bpe_50k.json")).count() == 0
    assert list(token_counts.balanced(((i, "é" * 4) for i in range(6)), 16)) == [[(0, "é" * 4), (1, "é" * 4)], [(2, "é" * 4), (3, "é" * 4)], [(4, "é" * 4), (5, "é" * 4)]]


def test_language_rows(spark, table):
    """Cosines with every centroid, in plain Python."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = language_id.fit(docs, ~language_id.held_out())
    df = QUERIES["op6_language_id"](spark, DATA)
    kinds = dict(df.dtypes)
    assert {c: kinds[c] for c in ("doc_id", "held_out", "lang_pred", "score")} == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    for r in df.collect():
        text = table[r["doc_id"]]["text"]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        if not any(c.isalpha() for c in text or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        v = np.log1p(language_id.gram_counts(text).astype(float)) * model.idf
        cos = [float(v @ c) / math.sqrt(float(v @ v)) for c in model.centres.astype(float)]
        assert abs(r["score"] - max(cos)) < 1e-4 and max(c for c, o in zip(cos, model.owner) if model.languages[o] == r["lang_pred"]) > max(cos) - 1e-4


def test_language_of_many(spark):
    """200 languages of few, often repeated ids: each has centroids; an empty table gives no rows; long texts count whole."""
    rows = [(100 * i + j % 3, " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x{k}{chr(97 + (i * k) % 26)}" for k in range(20)), f"l{i:03}") for i in range(200) for j in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(df, df["doc_id"].isNotNull(), per_language=3)
    assert len(model.languages) == 200 and language_id.identify(df.limit(0), model).count() == 0
    long = "der Text und die Wörter " * 60_000
    assert abs(int(language_id.gram_counts(long).sum()) - 2 * len((" " + " ".join(long.split()) + " ").encode())) <= 8


def test_quality_rows(spark, table):
    """Base columns by brute force; the verdict by the learned rules in plain Python."""
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rules = quality_rules.fit(docs, labels)
    df = QUERIES["op8_quality_rules"](spark, DATA)
    kinds = dict(df.dtypes)
    assert all(kinds[c] == "bigint" for c in ("doc_id", *quality_rules.BASE)) and kinds["base_failed"] == kinds["kept"] == "boolean"
    for r in df.collect():
        text = table[r["doc_id"]]["text"]
        assert tuple(r[c] for c in quality_rules.BASE) == brute_statistics(text)
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        x = dict(zip([*quality_rules.BASE, *quality_rules.RATES], quality_rules.statistics((text or "").encode())))
        first = next((i for i, rule in enumerate(rules, 1) if all((x[c.feature] >= c.threshold) == c.above for c in rule)), 0)
        assert (r["base_failed"], r["kept"], r["rule"]) == (failed, not failed and first == 0, first)


def test_quality_of_string_ids(spark):
    """Ids of any type; repeated documents and labels count once; an empty table."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    text = lambda df: df.withColumn("doc_id", df["doc_id"].cast("string"))
    once = quality_rules.fit(text(docs), text(labels))
    assert once and once == quality_rules.fit(text(docs.unionByName(docs)), text(labels.unionByName(labels)))
    assert quality_rules.labelled_statistics(docs.unionByName(docs), labels, sample=50).count() <= 50
    assert quality_rules.fit(docs.limit(0), labels) == [] and quality_rules.with_statistics(docs.limit(0)).count() == 0


def test_removal_keeps_any_column(spark):
    df = spark.createDataFrame([(1, "a b c", "x", "y"), (2, "q r s", "z", None)], "doc_id bigint, text string, overlap string, __overlap string")
    items = spark.createDataFrame([("i", "b c")], "item_id string, text string")
    assert [tuple(r) for r in decontamination.remove_documents(df, items).collect()] == [(2, "q r s", "z", None)]
    assert sorted(tuple(r) for r in decontamination.remove_spans(df, items, mark="-").collect()) == [(1, "a -", "x", "y"), (2, "q r s", "z", None)]
    long = "word " * 300_000 + "b c " + "word " * 10
    found = decontamination.find_overlaps(spark.createDataFrame([(1, long)], "doc_id bigint, text string"), items).first()["overlap"]
    assert (found["n_words"], [tuple(s) for s in found["spans"]], found["items"]) == (300_012, [(300_000, 300_002)], ["i"])


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Nulls in every column, repeated rows, columns that clash, very long and empty texts; an empty table; no benchmark."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    base = [(i, f"the of and that with for {' '.join(f'word{(i * k) % 97}' for k in range(40))}", "en", "s", 1) for i in range(60)]
    base += [(100, None, "en", "s", 0), (101, "", None, None, None), (None, "the of and that with for word5 word60 word7 word81 word9 word33 word21 word4 word77", "en", None, 5), (103, "the of and that with " * 60_000 + "tail", "en", "s", 9)] + [base[3]] * 2
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for name, rows in (("odd", base), ("none", [])):
        df = spark.createDataFrame(rows, kinds)
        extra = df.selectExpr("*", "1 as h", "2 as `row`", "'x' as root", "3 as `end`", "4 as overlap", "5 as spans", "6 as own", "7 as __id")
        folder = tmp_path / name
        extra.write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([("a", "word1 word2"), (None, None)], "item_id string, text string").write.parquet(str(folder / "benchmark.parquet"))
        out = corpus_pipeline.run(spark, str(folder)).collect()
        ids = [r["doc_id"] for r in out]
        assert len(ids) == len(set(ids)) and (len(ids) > 30 and {None, 103} <= set(ids) and not {100, 101} & set(ids) if rows else not ids)
        assert all(r["n_tokens"] == len(r["ids"]) for r in out)
