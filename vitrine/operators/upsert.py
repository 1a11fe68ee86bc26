"""Merge semantics over plain Parquet tables: result frames, and an atomic swap to store them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import latest_per_key


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    insert_defaults: dict[str, Column] | None = None,
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """Insert new keys, overwrite ``update_cols`` of known ones (a null overwrites too), keep the rest.

    Of several source rows with one key the last by ``order`` wins. Columns that the source lacks take
    ``insert_defaults`` on insert, else null. Keys that are null match nothing and are always inserted,
    as in SQL.
    """
    defaults = insert_defaults or {}
    src = latest_per_key(source, keys, order or list(keys))
    packed = src.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.struct(*[F.col(c) for c in src.columns]).alias("__s"))
    tgt = target.withColumn("__t", F.lit(True))
    on = [tgt[k] == packed[f"__k_{k}"] for k in keys]
    joined = tgt.join(packed, on, "full_outer")
    known, fresh = F.col("__t").isNotNull(), F.col("__s").isNotNull()

    def value(c: str) -> Column:
        kind = target.schema[c].dataType
        new = F.col("__s")[c] if c in src.columns else None
        first = (new if new is not None else defaults.get(c, F.lit(None))).cast(kind)
        if c in defaults and new is not None:
            first = F.coalesce(new, defaults[c]).cast(kind)
        if c in update_cols and new is not None:
            return F.when(known & fresh, new.cast(kind)).when(known, F.col(c)).otherwise(first).alias(c)
        return F.when(known, F.col(c)).otherwise(first).alias(c)

    return joined.select(*[value(c) for c in target.columns])


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``ON CONFLICT DO NOTHING``: source rows with new keys are added, nothing is changed."""
    fresh = source.select(*target.columns).dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh)


def replace_groups(target: DataFrame, source: DataFrame, group: Sequence[str]) -> DataFrame:
    """Every group present in ``source`` is replaced whole; other groups stay (no stale rows)."""
    kept = target.join(source.select(*group).distinct(), list(group), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def _files(spark, path: str):
    jvm = spark._jvm
    now, new, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}__next", f"{path}__prev"))
    return now.getFileSystem(spark._jsc.hadoopConfiguration()), now, new, old


def recover(spark, path: str) -> None:
    """Ends a swap that was cut off: a missing table is the new one if that was written whole, else the one before."""
    fs, now, new, old = _files(spark, path)
    if fs.exists(now):
        return
    done = spark._jvm.org.apache.hadoop.fs.Path(new, "_SUCCESS")
    for whole in [new] * fs.exists(done) + [old] * fs.exists(old):
        if not fs.rename(whole, now):
            raise OSError(f"cannot restore {path}")
        return


def swap_in(df: DataFrame, path: str) -> None:
    """Write ``df`` beside ``path``, then rename: ``df`` may read ``path`` itself, and readers never see half a table.

    The table before is deleted only when the new one stands, and :func:`recover` (called here, and by readers) ends a swap that was cut off at any
    step. One writer at a time. On stores without renames (object stores) each rename is a copy of the table.
    """
    spark = df.sparkSession
    recover(spark, path)
    df.write.mode("overwrite").parquet(f"{path}__next")
    fs, now, new, old = _files(spark, path)
    if fs.exists(now):
        fs.delete(old, True)
        if not fs.rename(now, old):
            raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, now):
        raise OSError(f"cannot move the new table to {path}")
    fs.delete(old, True)
