"""Token frequencies per game and language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import english_tokens
from ..operators import top_n_per_group


def count_tokens(reviews: DataFrame, tokens: Column, group: list[str], ts: str | None = None) -> DataFrame:
    """``group, token, frequency, review_appearances``, and with ``ts`` the first and last time of reviews with the token. Counts of parts of the
    reviews add up to those of the whole.

    Tokens are computed once and sorted within a review, so a token's first place counts its review, and both counts come from one row per place,
    combined before the single shuffle.
    """
    times = [ts] if ts else []
    cols = list(dict.fromkeys([*group, *times]))
    sorted_tokens = reviews.select(*cols, F.array_sort(tokens).alias("__t"))
    marked = F.transform("__t", lambda t, i: F.struct(t.alias("token"), F.when(F.get(F.col("__t"), i - 1) == t, 0).otherwise(1).alias("a")))
    exploded = sorted_tokens.select(*cols, F.explode(marked).alias("x")).select(*cols, "x.*")
    return exploded.groupBy(*group, "token").agg(F.count("*").alias("frequency"), F.sum("a").alias("review_appearances"), *[f(ts).alias(n) for f, n in ((F.min, "first_at"), (F.max, "last_at")) if ts])


def top_tokens(counted: DataFrame, group: list[str], top_n: int, timed: bool) -> DataFrame:
    """The most frequent tokens of each group (ties: token ascending); with times, the span of all the group's tokens stands on each row."""
    if timed:
        whole = Window.partitionBy(*group)
        counted = counted.withColumns({"earliest_review_at": F.min("first_at").over(whole), "latest_review_at": F.max("last_at").over(whole)}).drop("first_at", "last_at")
    return top_n_per_group(counted, group, [F.desc("frequency"), F.asc("token")], top_n)


def token_frequencies(reviews: DataFrame, tokens: Column, group: list[str], top_n: int = 1000, ts: str | None = None) -> DataFrame:
    """Top ``top_n`` tokens of each group by frequency (ties: token ascending).

    ``frequency`` counts all places, ``review_appearances`` reviews. With ``ts``, the earliest and latest time of
    the group's reviews with any token stands on each row.
    """
    return top_tokens(count_tokens(reviews, tokens, group, ts), group, top_n, ts is not None)


def part_tokens(lake: DataFrame, noun_udf) -> DataFrame:
    """Token counts of each of the lake's partitions; languages other than English and Korean have no tokens."""
    group = ["appid", "language", "year", "month"]
    english = count_tokens(lake.where("language = 'english'"), english_tokens(F.col("review")), group, "timestamp_created")
    return english.unionByName(count_tokens(lake.where("language = 'korean'"), noun_udf("review"), group, "timestamp_created"))


def merged_tokens(parts: DataFrame, top_n: int = 1000, now: Column | None = None) -> DataFrame:
    """Top tokens of games and languages from the counts of their partitions."""
    group = ["app_id", "language"]
    whole = parts.withColumnRenamed("appid", "app_id").groupBy(*group, "token").agg(
        F.sum("frequency").alias("frequency"), F.sum("review_appearances").alias("review_appearances"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at")
    )
    return _gold_shape(top_tokens(whole, group, top_n, True), now)


def english_review_tokens(lake: DataFrame, top_n: int = 1000, now: Column | None = None) -> DataFrame:
    english = lake.where("language = 'english'").select(F.col("appid").alias("app_id"), "language", "review", "timestamp_created")
    return _gold_shape(token_frequencies(english, english_tokens(F.col("review")), ["app_id", "language"], top_n, "timestamp_created"), now)


def korean_review_tokens(lake: DataFrame, noun_udf, top_n: int = 1000, now: Column | None = None) -> DataFrame:
    korean = lake.where("language = 'korean'").select(F.col("appid").alias("app_id"), "language", "review", "timestamp_created")
    return _gold_shape(token_frequencies(korean, noun_udf("review"), ["app_id", "language"], top_n, "timestamp_created"), now)


def _gold_shape(df: DataFrame, now: Column | None) -> DataFrame:
    return df.select("app_id", "language", F.col("token").alias("morpheme"), F.col("frequency").cast("int").alias("frequency"), F.col("review_appearances").cast("int").alias("review_appearances"), "earliest_review_at", "latest_review_at", (F.current_timestamp() if now is None else now).alias("updated_at"))
