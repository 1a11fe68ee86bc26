"""Writers: one object, Parquet with a codec, and whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.upsert import swap_in

CODECS = ("snappy", "zstd", "gzip")


#: Control documents are written by the driver; larger ones are refused.
MOST_DOCUMENT_ROWS = 1_000_000


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """One object of UTF-8 text; it appears whole, under its name, or not at all."""
    target, part = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.part"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"cannot write {path}")


def write_json(df: DataFrame, path: str) -> None:
    """All rows as one object, a JSON array, which :func:`read_bronze_json` reads back; for control documents, which are small."""
    rows = df.toJSON().take(MOST_DOCUMENT_ROWS + 1)
    if len(rows) > MOST_DOCUMENT_ROWS:
        raise ValueError(f"{path}: more than {MOST_DOCUMENT_ROWS} rows are no control document")
    write_text(df.sparkSession, "[" + ",\n".join(rows) + "]", path)


def write_parquet(df: DataFrame, path: str, codec: str = "snappy", rows_per_file: int = 0) -> None:
    if codec not in CODECS:
        raise ValueError(f"codec {codec!r} is none of {', '.join(CODECS)}")
    writer = df.write.mode("overwrite").option("compression", codec)
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    swap_in(df, path)
