"""Trend marts refreshed where something changed: the changed rows, and the rows behind them whose baseline looks back on these.

A mart lies in partitions by day. Of the facts, only the days are read that hold the changed rows, the rows behind them that look back on them, and
the rows before that these look back on. Rows, not days, count for a baseline, so how many days that takes differs by game: spans of days grow until
they hold enough rows of each game concerned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.journal import Change
from .marts import Trend

#: Rows that a baseline looks back on.
ROWS = 7


def _short(rows: DataFrame, keys: DataFrame, wanted: int) -> bool:
    """Whether some key has fewer rows than wanted."""
    counts = keys.join(rows.groupBy("app_id").agg(F.count("*").alias("n")), "app_id", "left")
    return not counts.where(F.coalesce("n", F.lit(0)) < wanted).isEmpty()


def window_of_days(read: Callable[[list[str]], DataFrame], days: list[str], keys: DataFrame, touched: list[str]) -> list[str]:
    """The days that hold, of each key, ``ROWS`` rows before and behind the touched days, as far as there are any."""
    before, behind = [d for d in days if d < touched[0]], [d for d in days if d > touched[-1]]

    def span(side: list[str]) -> list[str]:
        n = ROWS
        while n < len(side) and _short(read(side[:n]), keys, ROWS):
            n *= 2
        return side[:n]

    return sorted({*span(before[::-1]), *(d for d in days if touched[0] <= d <= touched[-1]), *span(behind)})


def affected(daily: DataFrame, touched: list[str]) -> DataFrame:
    """Rows on touched days, and the ``ROWS`` rows of the game behind each of these days."""
    last = F.array_max(F.filter(F.array(*[F.lit(d) for d in touched]), lambda d: d <= F.col("date").cast("string")))
    marked = daily.withColumn("__last", last).where("__last is not null")
    behind = Window.partitionBy("app_id", "__last").orderBy("date")
    on = F.col("date").cast("string") == F.col("__last")
    numbered = marked.withColumn("__n", F.row_number().over(behind) - F.max(on.cast("int")).over(Window.partitionBy("app_id", "__last")))
    return numbered.where(F.col("__n") <= ROWS).drop("__n", "__last")


def refresh(change: Change, trend: Trend, path: str, mart: DataFrame | None, facts: Callable[[list[str]], DataFrame], days: list[str], touched: list[str], keys: DataFrame, prices: DataFrame, games: DataFrame) -> list[str]:
    """Stages the mart at ``path`` with the rows on which changes of the facts or prices of the games ``keys`` on ``touched`` days have an effect; returns
    the days read.

    ``facts`` reads the fact rows of some days, ``days`` are those that there are. Without a mart all is built. Days on which no row is left go."""
    named = lambda df: df.withColumn("day", F.col("date").cast("string"))
    if mart is None:
        if days:
            change.replace_partitions(named(trend.whole(facts(days), prices, games)).sortWithinPartitions("app_id", "date"), path, ["day"])
        return days
    touched = sorted(set(touched))
    if not touched:
        return []
    staged = change.folder(f"keys-{len(change.moves)}")
    keys.distinct().write.parquet(staged)
    keys = keys.sparkSession.read.parquet(staged)
    read = lambda some: trend.daily(facts(some)).join(keys, "app_id", "left_semi")
    wide = window_of_days(read, days, keys, touched)
    rows = trend.finish(affected(trend.with_baseline(read(wide)), touched), prices.where(F.col("collected_at").cast("string").isin(wide)), games)
    again = change.folder(f"rows-{len(change.moves)}")
    named(rows).write.parquet(again)
    rows = rows.sparkSession.read.parquet(again)
    into = sorted({r["day"] for r in rows.select("day").distinct().collect()} | set(touched))
    stay = mart.where(F.col("day").isin(into)).join(rows.select("app_id", "day"), ["app_id", "day"], "left_anti")
    # What stood on a touched day and has no row now is gone.
    stay = stay.join(keys.withColumn("__t", F.lit(True)), "app_id", "left").where(F.col("__t").isNull() | ~F.col("day").isin(touched)).select(*rows.columns)
    change.replace_partitions(stay.unionByName(rows).sortWithinPartitions("app_id", "date"), path, ["day"], dropped=[f"day={d}" for d in into])
    return wide
