"""Staging projections over the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_games(dim_games: DataFrame) -> DataFrame:
    return dim_games.drop("total_reviews")


def stg_price_history(fact_price: DataFrame) -> DataFrame:
    return fact_price.select("app_id", "currency", "initial_price", "final_price", "discount_percent", "is_free", "discount_end_at", "collected_at")


def stg_concurrent_players(fact_players: DataFrame) -> DataFrame:
    return fact_players.select("app_id", "concurrent_in_game", F.to_date("collected_at").alias("snapshot_date"), F.col("collected_at").alias("snapshot_at"))


def stg_review_daily(fact: DataFrame) -> DataFrame:
    return fact.select("app_id", "language", "review_date", "review_count")


def stg_review_playtime_daily(fact: DataFrame) -> DataFrame:
    return fact.select("app_id", "language", "review_date", "avg_playtime_at_review", "avg_playtime_forever", "review_count", "updated_at")


def register_views(frames: dict[str, DataFrame]) -> None:
    """Staging models as temporary views."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
