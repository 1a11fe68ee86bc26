"""Readers of raw objects: declared schema, string-prefix globs, and the source file of every row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_bronze_json(spark: SparkSession, prefix: str, schema: str) -> DataFrame:
    """Multi-line JSON objects or arrays whose path starts with ``prefix``; adds ``_file``. Raises if none exists."""
    df = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(f"{prefix}*")
    return df.withColumn("_file", F.col("_metadata.file_path"))


def read_bronze_parquet(spark: SparkSession, prefix: str, schema: str) -> DataFrame:
    """Parquet chunks whose path starts with ``prefix``; a column that a chunk lacks is null. Adds ``_file``."""
    df = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{prefix}*")
    return df.withColumn("_file", F.col("_metadata.file_path"))


def latest_file_only(df: DataFrame) -> DataFrame:
    """Rows of the last file by name; the scalar subquery is one row, joined by equality."""
    last = df.select(F.max("_file").alias("_file"))
    return df.join(F.broadcast(last), "_file", "left_semi")
