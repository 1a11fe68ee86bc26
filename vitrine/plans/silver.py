"""Bronze feeds to silver rows. Every function maps frames to frames; run dates and clocks are arguments."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import epoch_to_timestamp, first_or_null, iso_timestamp, joined_names, normalize_language, release_date, safe_int
from ..operators import insert_only, latest_per_key, upsert
from ..schemas import AUTHOR, RAW_DETAILS, REVIEWS

CURRENCY = "KRW"
DIM_UPDATES = (
    "name type is_free required_age developers publishers release_date platforms_windows platforms_mac platforms_linux "
    "header_image_url total_recommendations updated_at"
).split()


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail fast on an empty feed."""
    if df.isEmpty():
        raise ValueError(f"no rows: {what}")
    return df


# ---- catalogue


def flatten_details(raw: DataFrame) -> DataFrame:
    """``appid, detail`` (JSON) to flat rows with defaults; genre ids that are no numbers go, unanswered apps go."""
    d = F.from_json("detail", RAW_DETAILS)
    blank, no = F.lit(""), F.lit(False)
    genres = F.transform(
        F.filter(F.coalesce(F.col("d.genres"), F.array().cast("array<struct<id:string,description:string>>")), lambda g: g["id"].rlike("^[0-9]+$")),
        lambda g: F.struct(g["id"].cast("int").alias("genre_id"), g["description"].alias("genre_name")),
    )
    return raw.where("detail is not null").select("appid", "collected_at", d.alias("d")).select(
        "appid", F.coalesce("d.name", blank).alias("name"), F.coalesce("d.type", blank).alias("type"), F.coalesce("d.is_free", no).alias("is_free"),
        F.coalesce(safe_int(F.col("d.required_age")), F.lit(0)).alias("required_age"), F.coalesce("d.short_description", blank).alias("short_description"),
        joined_names(F.col("d.developers")).alias("developers"), joined_names(F.col("d.publishers")).alias("publishers"), genres.alias("genres"),
        F.coalesce("d.platforms.windows", no).alias("platforms_windows"), F.coalesce("d.platforms.mac", no).alias("platforms_mac"),
        F.coalesce("d.platforms.linux", no).alias("platforms_linux"), F.coalesce("d.header_image", blank).alias("header_image"),
        F.coalesce("d.release_date.coming_soon", no).alias("release_date_coming_soon"), F.coalesce("d.release_date.date", blank).alias("release_date_str"),
        F.col("d.recommendations.total").alias("recommendations_total"), "collected_at",
    )


def game_rows(details: DataFrame, now: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if now is None else now
    renamed = details.withColumnsRenamed({"appid": "app_id", "header_image": "header_image_url", "recommendations_total": "total_recommendations"})
    return renamed.withColumns({"release_date": release_date(F.col("release_date_str")), "created_at": now, "updated_at": now})


def merge_games(dim_games: DataFrame, details: DataFrame, now: Column | None = None) -> DataFrame:
    rows = game_rows(details, now)
    order = ["_file"] if "_file" in rows.columns else ["collected_at"]
    return upsert(dim_games, rows.select(*[c for c in dim_games.columns if c in rows.columns], *[c for c in order if c not in dim_games.columns]), ["app_id"], DIM_UPDATES, order=order)


def genre_pairs(details: DataFrame) -> DataFrame:
    order = "_file" if "_file" in details.columns else "collected_at"
    return details.select(F.col("appid").alias("app_id"), F.col(order).alias("_order"), F.explode("genres").alias("g")).select("app_id", "g.genre_id", "g.genre_name", "_order").where("genre_id is not null")


def merge_genres(dim_genres: DataFrame, details: DataFrame) -> DataFrame:
    return upsert(dim_genres, genre_pairs(details).select("genre_id", "genre_name", "_order"), ["genre_id"], ["genre_name"], order=["_order", "genre_name"])


def merge_game_genres(dim_game_genres: DataFrame, details: DataFrame) -> DataFrame:
    return insert_only(dim_game_genres, genre_pairs(details), ["app_id", "genre_id"])


# ---- prices and the control table


def price_rows(discounts: DataFrame, run_date: date) -> DataFrame:
    """One row per store item of the snapshot, with its file and place; amounts stay raw integers, only the first active discount counts."""
    file = F.col("_file") if "_file" in discounts.columns else F.lit("")
    items = discounts.select(file.alias("_order"), F.posexplode("response.store_items").alias("_place", "i")).where("i.appid is not null")
    best = F.col("i.best_purchase_option")
    end = first_or_null(best["active_discounts"])["discount_end_date"]
    return items.select(
        F.col("i.appid").alias("app_id"),
        F.lit(CURRENCY).alias("currency"),
        safe_int(best["original_price_in_cents"]).alias("initial_price"),
        safe_int(best["final_price_in_cents"]).alias("final_price"),
        F.coalesce(best["discount_pct"], F.lit(0)).alias("discount_percent"),
        F.coalesce("i.is_free", F.lit(False)).alias("is_free"),
        F.when(end != 0, epoch_to_timestamp(end)).alias("discount_end_at"),
        F.lit(run_date).cast("date").alias("collected_at"),
        "_order", "_place",
    )


def merge_prices(fact: DataFrame, rows: DataFrame) -> DataFrame:
    cols = ["currency", "initial_price", "final_price", "discount_percent", "is_free", "discount_end_at"]
    order = [c for c in ("_order", "_place") if c in rows.columns] or ["final_price", "discount_end_at"]  # the last place wins
    return upsert(fact, rows, ["app_id", "collected_at"], cols, order=order)


def discounted_ids(discounts: DataFrame) -> DataFrame:
    return discounts.select(F.explode("response.ids.appid").alias("appid")).where("appid is not null").distinct()


def merge_tracked(tracked: DataFrame, ids: DataFrame, run_date: date) -> DataFrame:
    day = F.lit(run_date).cast("date")
    yes = F.lit(True)
    defaults = {"is_active": yes, "collect_reviews": yes, "collect_players": yes, "review_cursors": F.create_map().cast("map<string,string>")}
    return upsert(tracked, ids.select("appid", day.alias("first_seen"), day.alias("last_discounted")), ["appid"], ["last_discounted"], defaults)


def merge_cursors(tracked: DataFrame, cursors: DataFrame, now: Column | None = None) -> DataFrame:
    """``appid, language, cursor`` rows into the map column; unknown apps are ignored."""
    new = cursors.groupBy("appid").agg(F.map_from_entries(F.collect_set(F.struct("language", "cursor"))).alias("__c")).withColumnRenamed("appid", "__a")
    joined = tracked.join(new, F.col("appid") == F.col("__a"), "left")
    kept = F.map_filter(F.coalesce("review_cursors", F.create_map().cast("map<string,string>")), lambda k, _: ~F.array_contains(F.map_keys("__c"), k))
    return joined.select(*[
        F.when(F.col("__c").isNotNull(), F.map_concat(kept, "__c")).otherwise(F.col(c)).alias(c) if c == "review_cursors"
        else F.when(F.col("__c").isNotNull(), F.current_timestamp() if now is None else now).otherwise(F.col(c)).alias(c) if c == "reviews_collected_at"
        else F.col(c) for c in tracked.columns
    ])


# ---- players


def player_rows(counts: DataFrame) -> DataFrame:
    order = "_file" if "_file" in counts.columns else "collected_at"
    place = F.monotonically_increasing_id()  # a file of several lines is read by one task, in order
    return counts.select("*", place.alias("_at")).where("appid is not null and player_count is not null").select(F.col("appid").alias("app_id"), F.col("player_count").alias("concurrent_in_game"), iso_timestamp(F.col("collected_at")).alias("collected_at"), F.col(order).alias("_order"), F.col("_at").alias("_place"))


def merge_player_rows(fact: DataFrame, rows: DataFrame) -> DataFrame:
    """Of several counts of one game and time the last by file and place wins."""
    return upsert(fact, rows, ["app_id", "collected_at"], ["concurrent_in_game"], order=["_order", "_place"])


def merge_players(fact: DataFrame, counts: DataFrame) -> DataFrame:
    return merge_player_rows(fact, player_rows(counts))


# ---- reviews

#: What a review's JSON holds, without the id of the game.
RAW_REVIEW = REVIEWS.rsplit(", appid INT", 1)[0]


def parse_reviews(feed: DataFrame) -> DataFrame:
    """``appid, review`` (JSON) of the crawl to rows of the review schema; answers that are no JSON objects go."""
    parsed = feed.select("appid", F.from_json("review", RAW_REVIEW).alias("r")).where("r.recommendationid is not null")
    return parsed.select("r.*", "appid")


AUTHOR_FIELDS = [f.split(":")[0].strip() for f in AUTHOR[len("STRUCT<") : -1].split(",")]


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """Author fields side by side, epochs as timestamps, normal language names, year and month (0 without a time)."""
    created = epoch_to_timestamp(F.col("timestamp_created"))
    return (
        reviews.select("*", *[F.col(f"author.{f}").alias(f"author_{f}") for f in AUTHOR_FIELDS])
        .drop("author")
        .withColumns(
            {
                "timestamp_created": created,
                "timestamp_updated": epoch_to_timestamp(F.col("timestamp_updated")),
                "language": normalize_language(F.col("language")),
                "review_year": F.coalesce(F.year(created), F.lit(0)),
                "review_month": F.coalesce(F.month(created), F.lit(0)),
            }
        )
    )


def split_undated(reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dated rows, quarantine): rows without a creation time or a game never reach the lake's partitions."""
    placed = F.col("timestamp_created").isNotNull() & F.col("appid").isNotNull()
    return reviews.where(placed), reviews.where(~placed)


def merge_reviews(lake: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """Crawls deliver at least once: one row per review id stays, the one updated last."""
    both = fresh if lake is None else lake.unionByName(fresh, allowMissingColumns=True)
    return latest_per_key(both, ["appid", "recommendationid"], ["timestamp_updated", "timestamp_created", "review"])


#: Partition columns of the review lake.
LAKE_PARTS = ["appid", "language", "year", "month"]


def touched_partitions(lake: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """Partitions that ``fresh`` goes into, and those that hold an earlier row of one of its reviews (its language or time may have changed)."""
    to = fresh.select("appid", F.nullif(F.col("language"), F.lit("")).alias("language"), F.col("review_year").alias("year"), F.col("review_month").alias("month"))
    if lake is None:
        return to.distinct()
    held = lake.join(fresh.select("appid", "recommendationid"), ["appid", "recommendationid"], "left_semi")
    return to.union(held.select(*LAKE_PARTS)).distinct()


def review_daily(lake: DataFrame, now: Column | None = None) -> DataFrame:
    day = F.to_date("timestamp_created")
    return (
        lake.where("timestamp_created is not null")
        .groupBy(F.col("appid").alias("app_id"), "language", day.alias("review_date"))
        .agg(F.count("*").cast("int").alias("review_count"))
        .withColumn("updated_at", F.current_timestamp() if now is None else now)
    )


def review_playtime_daily(lake: DataFrame, now: Column | None = None) -> DataFrame:
    mean = lambda c: F.round(F.avg(c), 2).cast("decimal(10,2)")
    return (
        lake.where("timestamp_created is not null")
        .groupBy(F.col("appid").alias("app_id"), "language", F.to_date("timestamp_created").alias("review_date"))
        .agg(mean("author_playtime_at_review").alias("avg_playtime_at_review"), mean("author_playtime_forever").alias("avg_playtime_forever"), F.count("*").cast("int").alias("review_count"))
        .withColumn("updated_at", F.current_timestamp() if now is None else now)
    )


def merge_daily(fact: DataFrame, rows: DataFrame) -> DataFrame:
    """Replaces measures by key; rows come from a full recount of the lake, so replacing is right."""
    keys = ["app_id", "language", "review_date"]
    return upsert(fact, rows, keys, [c for c in fact.columns if c not in keys])
