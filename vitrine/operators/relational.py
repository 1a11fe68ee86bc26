"""Reusable relational operators; all take column names, none of them leaves the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _desc(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in cols]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first by ``order`` (strings sort descending, nulls last).

    ``row_number() = 1`` plans as WindowGroupLimit, so every task keeps one row per key before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*_desc(order))
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


dedupe_latest = latest_per_key


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group; ``order`` must be total for a stable result."""
    w = Window.partitionBy(*group).orderBy(*_desc(order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def ordered_string_agg(df: DataFrame, group: Sequence[str], value: str, alias: str, sep: str = ", ") -> DataFrame:
    """Strings of a group joined in binary order; nulls are skipped, a group of nulls gives null."""
    quoted = sep.replace("'", "\\'")
    return df.groupBy(*group).agg(F.expr(f"listagg(`{value}`, '{quoted}') within group (order by `{value}`)").alias(alias))


def baseline_avg(value: str, partition: str, order: str | Sequence[str], rows: int = 7) -> Column:
    """Mean over the ``rows`` rows before the current one (rows, not days); null on a group's first row."""
    by = [order] if isinstance(order, str) else order
    return F.avg(value).over(Window.partitionBy(partition).orderBy(*by).rowsBetween(-rows, -1))


def weighted_mean(value: str, weight: str) -> Column:
    """``sum(w*x) / nullif(sum(w), 0)``: a null value leaves the numerator but its weight stays below."""
    return F.sum(F.col(weight) * F.col(value)) / F.nullif(F.sum(weight), F.lit(0))


def running_sum(value: str, keys: Sequence[str], order: Sequence[str | Column]) -> Column:
    """Sum of doubles from a group's first row to this one, added up one by one: the last row's sum is the same however rows are dealt."""
    return F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def conditional_sums(value: str, by: str, cases: dict[str, str]) -> list[Column]:
    """One sum per fixed label of ``by``: ``{label: output name}``; rows of other labels count 0."""
    return [F.sum(F.when(F.col(by) == label, F.col(value)).otherwise(0)).alias(name) for label, name in cases.items()]


def active_semi_join(df: DataFrame, control: DataFrame, key: str, control_key: str, *flags: str) -> DataFrame:
    """Rows whose key is in the control table with all ``flags`` set.

    The side is not hinted: AQE broadcasts it when its measured size allows, and then prunes partitions by it.
    """
    active = control
    for flag in flags:
        active = active.where(F.col(flag))
    active = active.select(F.col(control_key).alias("__k")).distinct()
    return df.join(active, df[key] == F.col("__k"), "left_semi")


def keyed_update(target: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``UPDATE target SET cols = source.cols`` where keys match (``source`` unique by key); never inserts."""
    src = source.select(*keys, F.struct(*cols).alias("__new"))
    joined = target.join(src, list(keys), "left")
    return joined.select(*[F.when(F.col("__new").isNotNull(), F.col("__new")[c]).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in target.columns])


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; columns that a frame lacks are null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
