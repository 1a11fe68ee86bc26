"""One run of the storefront pipeline, in dependency order, from bronze prefixes to marts.

The reference schedule is wall-clock only; here the order is explicit, and ``run_date`` is an argument.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import noun_tokens
from ..operators import latest_per_key, recover
from ..operators.journal import Change, Journal
from ..sources import StoreApi, latest_file_only, read_bronze_json, read_bronze_parquet, replace_table
from . import bronze, gold, marts, silver, staging
from .lake import ReviewLake, replace_days
from .trends import refresh

TABLES = {
    "tracked_games": S.TRACKED_GAMES, "dim_games": S.DIM_GAMES, "dim_genres": S.DIM_GENRES, "dim_game_genres": S.DIM_GAME_GENRES,
    "fact_concurrent_players": S.FACT_PLAYERS, "fact_price_history": S.FACT_PRICE, "fact_review_daily": S.FACT_REVIEW_DAILY,
    "fact_review_playtime_daily": S.FACT_PLAYTIME_DAILY, "gold_review_morphemes": S.GOLD_TOKENS,
}

#: Tables in partitions, and the columns that name them: facts by the day of a column, tokens by group.
DAYS = {"fact_concurrent_players": "collected_at", "fact_price_history": "collected_at", "fact_review_daily": "review_date", "fact_review_playtime_daily": "review_date"}
PARTS = {**dict.fromkeys(DAYS, "day STRING"), "gold_review_morphemes": "game INT, lang STRING"}
#: Trend marts: their parts, the facts that they come from, and whose days they follow.
TRENDS = {
    "mart_discount_player_trend": (marts.PLAYER_TREND, "fact_concurrent_players", staging.stg_concurrent_players),
    "mart_discount_review_trend": (marts.REVIEW_TREND, "fact_review_daily", staging.stg_review_daily),
    "mart_discount_playtime_trend": (marts.PLAYTIME_TREND, "fact_review_playtime_daily", staging.stg_review_playtime_daily),
}
#: All days of the trend marts have to be built again.
EVERY = "every"
DAILY_KEYS = ["app_id", "language", "review_date"]


class Note(str):
    """What a step has to tell without having failed."""


@dataclass
class Report:
    """Outcome by step, the games that a step could not fetch, and what else it had to tell; ``colour`` is green without failures, red if all failed, else yellow."""

    done: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)
    skipped: dict[str, dict[int, str]] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)

    @property
    def colour(self) -> str:
        return "green" if not self.failed and not self.skipped else "yellow" if self.done else "red"


class Storefront:
    """Bronze prefixes and the warehouse's tables; both must lie in one store, since changes of both are moves of folders."""

    def __init__(self, spark: SparkSession, bronze: str, warehouse: str, korean_analyzer: Callable | None = None, index_buckets: int = 64):
        self.spark, self.bronze, self.root = spark, bronze, warehouse
        self.analyzer, self.nouns = korean_analyzer, noun_tokens(korean_analyzer or (lambda: None))
        self.journal, self.lake = Journal(spark, warehouse), ReviewLake(spark, warehouse, index_buckets)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        """Whether the table stands, after ending a change or a swap that was cut off."""
        if self.journal.pending():
            self.journal.recover()
        recover(self.spark, self.path(table))
        return self.journal.files.exists(self.path(table))

    def parted(self, name: str) -> DataFrame:
        """A table with the columns that name its partitions."""
        kinds = f"{TABLES[name]}, {PARTS[name]}" if name in PARTS else TABLES[name]
        return self.spark.read.schema(kinds).parquet(self.path(name)) if self.exists(name) else self.spark.createDataFrame([], kinds)

    def table(self, name: str) -> DataFrame:
        df = self.parted(name)
        return df.drop(*[p.split()[0] for p in PARTS[name].split(", ")]) if name in PARTS else df

    def save(self, name: str, df: DataFrame) -> None:
        replace_table(df, self.path(name))

    def touch(self, change: Change, rows: DataFrame, *facts: str) -> None:
        """Tells the trend marts which facts (``app_id, day``) were changed; prices concern all of them."""
        for mart, (_, fact, _) in TRENDS.items():
            if fact in facts or "fact_price_history" in facts:
                folder = change.folder(f"touched-{uuid.uuid4().hex}")
                rows.select(F.col("app_id").cast("int").alias("app_id"), "day").write.parquet(folder)
                change.move(folder, f"{self.root}/days_touched/{mart}/{uuid.uuid4().hex}")

    def merge_days(self, change: Change, name: str, rows: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Stages a fact table in which the days of ``rows`` are merged; other days keep their files."""
        day = F.date_format(DAYS[name], "yyyy-MM-dd")
        days = sorted(r["d"] for r in rows.select(day.alias("d")).where("d is not null").distinct().collect())  # the calendar bounds them
        if days:
            old = self.parted(name).where(F.col("day").isin(days)).drop("day")
            change.replace_partitions(merge(old, rows).withColumn("day", day), self.path(name), ["day"])
            self.touch(change, rows.select("app_id", day.alias("day")).distinct(), name)

    def load_prices(self, run_date: date) -> Note | None:
        feed = latest_file_only(read_bronze_json(self.spark, f"{self.bronze}/discount_games/{run_date:%Y%m%d}", S.DISCOUNT_GAMES))
        change, rows = self.journal.begin(), silver.price_rows(feed, run_date)
        change.replace(silver.merge_tracked(self.table("tracked_games"), silver.discounted_ids(feed), run_date), self.path("tracked_games"))
        self.merge_days(change, "fact_price_history", rows, silver.merge_prices)
        change.commit()
        return Note("the day's answer has no items") if rows.isEmpty() else None

    def load_players(self, run_date: date) -> None:
        feed = silver.require_rows(read_bronze_json(self.spark, f"{self.bronze}/player_counts/{run_date:%Y%m%d}", S.PLAYER_COUNTS), "player counts")
        change = self.journal.begin()
        # Rows are staged first: a count without a time is dated now, and all that follows must see the same now.
        rows = change.folder("players")
        silver.player_rows(feed).write.parquet(rows)
        self.merge_days(change, "fact_concurrent_players", self.spark.read.parquet(rows), silver.merge_player_rows)
        change.commit()

    def load_details(self, run_date: date) -> None:
        feed = silver.require_rows(read_bronze_parquet(self.spark, f"{self.bronze}/appdetails/{run_date:%Y%m%d}", S.APP_DETAILS), "app details")
        before = self.table("dim_games").select(F.col("app_id").alias("__a"), F.col("name").alias("__n"))
        change = self.journal.begin()
        games = change.replace(silver.merge_games(self.table("dim_games"), feed), self.path("dim_games"))
        named = games.join(before, F.col("app_id") == F.col("__a"), "left").where(~F.col("name").eqNullSafe(F.col("__n")))
        if not named.isEmpty():  # trends show names, on all days
            self.touch(change, self.spark.createDataFrame([(None, EVERY)], "app_id int, day string"), "fact_price_history")
        change.commit()
        self.save("dim_genres", silver.merge_genres(self.table("dim_genres"), feed))
        self.save("dim_game_genres", silver.merge_game_genres(self.table("dim_game_genres"), feed))

    def load_reviews(self, run_date: date) -> None:
        """The day's chunks into the lake; which of them were loaded before makes no difference."""
        feed = silver.require_rows(read_bronze_parquet(self.spark, f"{self.bronze}/reviews/{run_date:%Y%m%d}", S.REVIEWS), "reviews")
        self.add_reviews(feed.drop("_file"))

    def add_reviews(self, reviews: DataFrame) -> None:
        """Reviews as the feed brings them into the lake, those without a time or a game into quarantine: one change."""
        dated, undated = silver.split_undated(silver.clean_reviews(reviews))
        if self.exists("reviews") and not self.lake.index.generations():
            change = self.journal.begin()
            self.lake.build_index(change)
            change.commit()
        quarantine = self.spark.read.parquet(self.path("reviews_quarantine")).unionByName(undated, allowMissingColumns=True) if self.exists("reviews_quarantine") else undated
        change = self.journal.begin()
        change.replace(latest_per_key(quarantine, ["appid", "recommendationid"], ["timestamp_updated", "review"]), self.path("reviews_quarantine"))
        self.lake.merge(change, dated)
        change.commit()

    def _active(self, consumer: str) -> tuple[DataFrame, list[int]]:
        """Active games, and those of them that were not when the consumer last ran; the store's catalogue bounds them."""
        active = self.table("tracked_games").where("is_active").select("appid").distinct()
        before = f"active_{consumer}"
        seen = self.spark.read.parquet(self.path(before)) if self.exists(before) else active.limit(0)
        return active, [r["appid"] for r in active.join(seen, "appid", "left_anti").collect()]

    def _touched(self, consumer: str) -> tuple[Change, DataFrame]:
        """A change that takes note of what was touched, and those partitions (also all of newly active games) as far as their games are active."""
        change = self.journal.begin()
        active, new = self._active(consumer)
        parts, lists = self.lake.touched(consumer)
        # Lists of inactive games' partitions can go: when such a game is active again, all its partitions are taken.
        staged = change.folder("parts")
        parts.unionByName(self.lake.parts_of(new)).distinct().join(active, "appid", "left_semi").write.parquet(staged)
        for path in lists:
            change.drop(path)
        change.replace(active, self.path(f"active_{consumer}"))
        return change, self.spark.read.schema(ReviewLake.PARTS).parquet(staged)

    def load_review_facts(self) -> None:
        """Counts the touched partitions of the lake again and replaces the days on which that changes a row."""
        change, parts = self._touched("facts")
        rows = self.lake.rows(self.lake.standing(self.lake.folders(parts)))
        for name, count in (("fact_review_daily", silver.review_daily), ("fact_review_playtime_daily", silver.review_playtime_daily)):
            changed = replace_days(change, self.path(name), self.parted(name), count(rows), parts, DAILY_KEYS, "review_date")
            if changed is not None:
                self.touch(change, changed, name)
        change.commit()

    def load_tokens(self, top_n: int = 1000) -> Note | None:
        """Counts tokens of the touched partitions, and refreshes the top tokens of the games and languages that they belong to."""
        change, parts = self._touched("tokens")
        folders = self.lake.folders(parts)
        counts = self.path("review_token_counts")
        counted = gold.part_tokens(self.lake.rows(self.lake.standing(folders)), self.nouns)
        new = change.replace_partitions(counted.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0")), counts, silver.LAKE_PARTS, dropped=folders)
        # What a touched group's other partitions hold was counted before.
        groups = sorted({f.split("/year=")[0] for f in folders})
        files = self.journal.files
        paths = [f"{counts}/{g}/{leaf}" for g in groups if files.exists(f"{counts}/{g}") for leaf in files.leaves(f"{counts}/{g}", 2) if f"{g}/{leaf}" not in set(folders)]
        kinds = f"token STRING, frequency BIGINT, review_appearances BIGINT, first_at TIMESTAMP, last_at TIMESTAMP, {ReviewLake.PARTS}"
        kept = self.spark.read.schema(kinds).option("basePath", counts).parquet(*paths) if paths else self.spark.createDataFrame([], kinds)
        fresh = gold.merged_tokens(self.spark.read.schema(kinds).parquet(new).unionByName(kept), top_n).withColumns({"game": F.col("app_id"), "lang": F.col("language")})
        gone = [g.replace("appid=", "game=").replace("/language=", "/lang=") for g in groups]
        change.replace_partitions(fresh, self.path("gold_review_morphemes"), ["game", "lang"], dropped=gone)
        change.commit()
        if self.analyzer is None and any("/language=korean/" in f for f in folders):
            return Note("no noun analyzer is given: Korean reviews have no tokens")
        return None

    def staged(self) -> dict[str, DataFrame]:
        t = self.table
        return {
            "stg_games": staging.stg_games(t("dim_games")),
            "stg_price_history": staging.stg_price_history(t("fact_price_history")),
            "stg_concurrent_players": staging.stg_concurrent_players(t("fact_concurrent_players")),
            "stg_review_daily": staging.stg_review_daily(t("fact_review_daily")),
            "stg_review_playtime_daily": staging.stg_review_playtime_daily(t("fact_review_playtime_daily")),
        }

    def build_marts(self) -> dict[str, DataFrame]:
        s = self.staged()
        staging.register_views(s)
        games, prices = s["stg_games"], s["stg_price_history"]
        out = {
            "mart_game_overview": marts.mart_game_overview(games, prices, self.table("dim_game_genres"), self.table("dim_genres")),
            "mart_player_daily_avg": marts.mart_player_daily_avg(s["stg_concurrent_players"]),
            "mart_discount_analysis": marts.mart_discount_analysis(prices, games),
        }
        for name, df in out.items():
            df.write.mode("overwrite").parquet(self.path(name))
        for name in TRENDS:
            self.refresh_trend(name, prices, games)
        standing = [*out, *(name for name in TRENDS if self.exists(name))]
        return {name: self.spark.read.parquet(self.path(name)) for name in standing}

    def refresh_trend(self, name: str, prices: DataFrame, games: DataFrame) -> list[str]:
        """Builds a trend mart again where facts or prices were changed since the last time; returns the days of facts that were read."""
        trend, fact, staged = TRENDS[name]
        change, files = self.journal.begin(), self.journal.files
        top = f"{self.root}/days_touched/{name}"
        lists = [f"{top}/{n}" for n in files.names(top)]
        rows = self.spark.read.schema("app_id INT, day STRING").parquet(*lists).distinct() if lists else self.spark.createDataFrame([], "app_id INT, day STRING")
        touched = {r["day"] for r in rows.select("day").distinct().collect()}  # the calendar bounds them
        for path in lists:
            change.drop(path)
        days = [n.removeprefix("day=") for n in files.names(self.path(fact)) if n.startswith("day=")]
        mart = self.spark.read.parquet(self.path(name)).withColumn("day", F.col("day").cast("string")) if self.exists(name) and EVERY not in touched else None
        if mart is None and self.exists(name):
            change.drop(self.path(name)) if not days else None
        facts = lambda some: staged(self.parted(fact).where(F.col("day").isin(some)).drop("day"))
        read = refresh(change, trend, self.path(name), mart, facts, days, sorted(touched - {EVERY}), rows.select("app_id"), prices, games)
        change.commit()
        return read

    def crawl(self, run_date: date, api: StoreApi, clock: str | None = None, **options: str) -> Report:
        """Fetches all feeds into bronze: prices first, since they name the games to follow; review cursors go back to the control table.

        ``clock`` names the snapshots of prices and players; by default it is the time of day, so crawls of one day stand side by side."""
        s, b = self.spark, self.bronze
        clock = f"{datetime.now(timezone.utc):%H%M%S%f}" if clock is None else clock

        def reviews() -> bronze.Skipped:
            """The chunk and the cursors behind it are one change."""
            change = self.journal.begin()
            tracked, skipped = bronze.crawl_reviews(s, self.table("tracked_games"), b, run_date, change=change, **options)
            change.replace(tracked, self.path("tracked_games"))
            change.commit()
            return skipped

        return self._steps([
            ("prices", lambda: (bronze.crawl_prices(s, api, b, run_date, clock), self.load_prices(run_date))),
            ("players", lambda: bronze.crawl_players(s, self.table("tracked_games"), b, run_date, clock, **options)),
            ("details", lambda: bronze.crawl_details(s, self.table("tracked_games"), b, run_date, **options)),
            ("reviews", reviews),
        ])

    def run(self, run_date: date) -> Report:
        """All steps; a failed feed is reported and does not stop the others, a run in which all fail raises."""
        return self._steps([("prices", lambda: self.load_prices(run_date)), ("details", lambda: self.load_details(run_date)), ("players", lambda: self.load_players(run_date)), ("reviews", lambda: self.load_reviews(run_date)), ("review facts", self.load_review_facts), ("tokens", self.load_tokens), ("marts", self.build_marts)])

    @staticmethod
    def _steps(steps: list[tuple[str, Callable]]) -> Report:
        report = Report()
        for name, step in steps:
            try:
                told = step()
                report.done.append(name)
                for x in told if isinstance(told, tuple) else (told,):
                    if isinstance(x, bronze.Skipped) and x:
                        report.skipped[name] = dict(x)
                    elif isinstance(x, Note):
                        report.notes[name] = str(x)
            except Exception as e:  # noqa: BLE001
                report.failed[name] = f"{type(e).__name__}: {e}"[:500]
        if not report.done:
            raise RuntimeError(f"every step failed: {report.failed}")
        return report
