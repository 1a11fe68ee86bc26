"""Gold marts as functions of staging frames.

Dimensions are joined without a hint: they are small today, and AQE broadcasts them as long as their measured
size allows. Facts are partitioned by ``app_id`` once, which serves the daily aggregate, the price join and
the trailing window.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import baseline_avg, conditional_sums, latest_per_key, ordered_string_agg, running_sum, weighted_mean


def price_by_date(prices: DataFrame, *cols: str) -> DataFrame:
    return prices.select("app_id", F.col("collected_at").alias("price_date"), "discount_percent", (F.col("discount_percent") > 0).alias("is_discounted"), *cols)


def _with_prices(daily: DataFrame, day: str, prices: DataFrame, games: DataFrame, *cols: str) -> DataFrame:
    """Left joins with the day's price and the game's name; both are unique by key, so rows stay as they are."""
    p = price_by_date(prices, *cols).withColumnsRenamed({"app_id": "__a"})
    names = games.select(F.col("app_id").alias("__g"), F.col("name").alias("game_name"))
    return daily.join(p, (F.col("app_id") == F.col("__a")) & (F.col(day) == F.col("price_date")), "left").join(names, F.col("app_id") == F.col("__g"), "left")


def _discounted() -> Column:
    return F.coalesce("is_discounted", F.lit(False))


def _percent() -> Column:
    return F.coalesce("discount_percent", F.lit(0))


def _ab_group() -> Column:
    return F.when(_discounted(), "discount").otherwise("normal")


def reviews_with_price(reviews: DataFrame, prices: DataFrame) -> DataFrame:
    """Daily review counts beside the day's price, for discount against normal comparisons of single games; days without a price keep nulls."""
    p = price_by_date(prices).withColumnsRenamed({"app_id": "__a"})
    joined = reviews.join(p, (F.col("app_id") == F.col("__a")) & (F.col("review_date") == F.col("price_date")), "left")
    return joined.select("app_id", "review_date", "review_count", "is_discounted", "discount_percent")


def mart_player_daily_avg(players: DataFrame, order: str | None = None) -> DataFrame:
    """Daily mean, largest, smallest and number of a game's counts.

    Whole numbers add up to the same in any order. Fractional ones don't, and a mean at a half is then rounded up or down by the order of its rows:
    with ``order`` they are added one by one in the order of that column."""
    keys, mean = ["app_id", "snapshot_date"], F.avg("concurrent_in_game")
    if order is not None:
        players = players.withColumn("__sum", running_sum("concurrent_in_game", keys, [order]))
        mean = F.max_by("__sum", order) / F.nullif(F.count("concurrent_in_game"), F.lit(0))
    return players.groupBy(*keys).agg(
        F.round(mean).alias("avg_concurrent"),
        F.max("concurrent_in_game").alias("max_concurrent"),
        F.min("concurrent_in_game").alias("min_concurrent"),
        F.count("*").alias("snapshot_count"),
    )


def mart_game_overview(games: DataFrame, prices: DataFrame, game_genres: DataFrame, genres: DataFrame) -> DataFrame:
    latest = latest_per_key(prices, ["app_id"], ["collected_at"]).select("app_id", "initial_price", "final_price", "discount_percent", F.col("collected_at").alias("price_collected_at"))
    names = ordered_string_agg(game_genres.join(genres, "genre_id"), ["app_id"], "genre_name", "genres")
    wide = games.join(names, "app_id", "left").join(latest, "app_id", "left")
    return wide.select(
        "app_id", "name", "type", "is_free", "developers", "publishers", "release_date", "platforms_windows", "platforms_mac", "platforms_linux",
        "total_recommendations", "genres", "initial_price", "final_price", "discount_percent", "price_collected_at",
    )


def mart_discount_analysis(prices: DataFrame, games: DataFrame) -> DataFrame:
    names = games.select("app_id", "name")
    return (
        prices.where("discount_percent > 0")
        .join(names, "app_id", "left")
        .groupBy("app_id", "name")
        .agg(
            F.count("*").alias("discount_count"),
            F.round(F.avg("discount_percent")).alias("avg_discount_pct"),
            F.max("discount_percent").alias("max_discount_pct"),
            F.min("final_price").alias("lowest_price"),
            F.max("initial_price").alias("original_price"),
            F.min("collected_at").alias("first_seen_discount"),
            F.max("collected_at").alias("last_seen_discount"),
        )
    )


@dataclass(frozen=True)
class Trend:
    """A mart of daily rows beside the day's price with a trailing baseline, in three parts: so it can be built whole, or only where something changed.

    ``daily`` gives rows by ``app_id, date`` from the facts, each from rows of its own day alone; ``value`` is averaged over the rows before, as
    ``baseline``; ``finish`` adds prices and names."""

    daily: Callable[[DataFrame], DataFrame]
    value: str
    baseline: str
    finish: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]

    def with_baseline(self, daily: DataFrame) -> DataFrame:
        return daily.withColumn(self.baseline, baseline_avg(self.value, "app_id", "date"))

    def whole(self, facts: DataFrame, prices: DataFrame, games: DataFrame) -> DataFrame:
        return self.finish(self.with_baseline(self.daily(facts)), prices, games)


def _player_days(players: DataFrame, order: str | None = None) -> DataFrame:
    return mart_player_daily_avg(players, order).select("app_id", F.col("snapshot_date").alias("date"), "avg_concurrent", "max_concurrent")


def _player_trend(daily: DataFrame, prices: DataFrame, games: DataFrame) -> DataFrame:
    return _with_prices(daily, "date", prices, games, "initial_price", "final_price", "discount_end_at").select(
        "app_id", "game_name", "date", "avg_concurrent", "max_concurrent", _percent().alias("discount_percent"),
        _discounted().alias("is_discounted"), "initial_price", "final_price", "discount_end_at", "baseline_7d_avg",
    )


def _review_days(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("app_id", F.col("review_date").alias("date")).agg(
        F.sum("review_count").alias("total_review_count"), *conditional_sums("review_count", "language", {"korean": "korean_review_count", "english": "english_review_count"})
    )


def _review_trend(daily: DataFrame, prices: DataFrame, games: DataFrame) -> DataFrame:
    return _with_prices(daily, "date", prices, games, "initial_price", "final_price", "discount_end_at").select(
        "app_id", "game_name", "date", "total_review_count", "korean_review_count", "english_review_count",
        _discounted().alias("is_discounted"), _percent().alias("discount_percent"), "initial_price", "final_price", "discount_end_at",
        _ab_group().alias("ab_group"), "baseline_7d_avg",
    )


def _playtime_days(playtime: DataFrame) -> DataFrame:
    return playtime.groupBy("app_id", F.col("review_date").alias("date")).agg(
        F.sum("review_count").alias("total_review_count"),
        weighted_mean("avg_playtime_at_review", "review_count").alias("at_review"),
        weighted_mean("avg_playtime_forever", "review_count").alias("forever"),
    )


def _playtime_trend(daily: DataFrame, prices: DataFrame, games: DataFrame) -> DataFrame:
    hours = lambda c: F.round(F.col(c) / 60, 2)
    return _with_prices(daily, "date", prices, games).select(
        "app_id", "game_name", "date", F.round("at_review", 2).alias("avg_playtime_at_review_min"),
        F.round("forever", 2).alias("avg_playtime_forever_min"), hours("at_review").alias("avg_playtime_at_review_hr"),
        hours("forever").alias("avg_playtime_forever_hr"), "total_review_count", _discounted().alias("is_discounted"),
        _percent().alias("discount_percent"), _ab_group().alias("ab_group"), "baseline_7d_avg_playtime",
    )


PLAYER_TREND = Trend(_player_days, "avg_concurrent", "baseline_7d_avg", _player_trend)
REVIEW_TREND = Trend(_review_days, "total_review_count", "baseline_7d_avg", _review_trend)
PLAYTIME_TREND = Trend(_playtime_days, "at_review", "baseline_7d_avg_playtime", _playtime_trend)


def mart_discount_player_trend(players: DataFrame, prices: DataFrame, games: DataFrame, order: str | None = None) -> DataFrame:
    """``order`` as in :func:`mart_player_daily_avg`."""
    return replace(PLAYER_TREND, daily=lambda p: _player_days(p, order)).whole(players, prices, games)


def mart_discount_review_trend(reviews: DataFrame, prices: DataFrame, games: DataFrame) -> DataFrame:
    return REVIEW_TREND.whole(reviews, prices, games)


def mart_discount_playtime_trend(playtime: DataFrame, prices: DataFrame, games: DataFrame) -> DataFrame:
    return PLAYTIME_TREND.whole(playtime, prices, games)
