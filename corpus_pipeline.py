"""A corpus pipeline over ``documents``: each stage calls one operator on all that the stage before kept.

Languages that can't be told go, one document of each group of near duplicates stays, documents with benchmark passages go,
personal data is masked, and what is left is encoded. Stages return the columns of ``documents``; the last returns ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import decontamination, language_id, near_duplicates, personal_data, piece_encoding
from vitrine.llm.common import read_table, remove, scratch_path
from vitrine.llm.queries import vocabulary

#: SQL has no nearest centroids, fingerprints or encoders: run() is tested against a brute-force version instead.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told; trains on all but the held-out fifth."""
    model = language_id.fit(docs, ~language_id.held_out())
    told = language_id.identify(docs, model, keep=docs.columns)
    return told.where("not lang_rejected").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.keep_one_similar(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = personal_data.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, decoded_sha256): the ids, and a digest of what they decode to."""
    model = vocabulary("piece_bpe_32k.model")
    coded = piece_encoding.round_trip(docs, model, keep=["doc_id", "lang", "source"], ids=True)
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256")


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("personal_data", mask_personal_data),
    ("piece_encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again, and deleted once the next one stands."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
