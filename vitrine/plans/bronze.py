"""Bronze jobs: what the feeds answer, stored for the silver plans, and the control table's cursors kept."""

from __future__ import annotations

import hashlib
import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.journal import Change, Journal
from ..session import ship
from ..sources import StoreApi, write_json, write_parquet, write_text
from ..sources.store_feed import StoreError, StoreFeedSource
from . import silver


def crawl_targets(tracked: DataFrame, *flags: str, newest_first: bool = True, limit: int | None = None) -> DataFrame:
    """Games of the control table with all ``flags``, those discounted last first (nulls first, as the store's database sorts), or by app id; a limit cuts."""
    active = tracked
    for flag in ("is_active", *flags):
        active = active.where(F.col(flag))
    order = [F.desc_nulls_first("last_discounted"), F.asc("appid")] if newest_first else [F.asc("appid")]
    ordered = active.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


class Skipped(dict):
    """Error by app id of what a crawl could not fetch."""


def _feed(spark: SparkSession, feed: str, ids: list[int], raw: str, options: dict[str, str]) -> tuple[DataFrame, Skipped]:
    """Answers of all games, stored raw at ``raw`` first, so that whatever is derived comes from the same ones; and the games that failed. Raises if all did."""
    ship(spark)
    spark.dataSource.register(StoreFeedSource)
    spark.read.format("store_feed").options(**{**options, "feed": feed, "errors": "true", "app_ids": ",".join(map(str, ids))}).load().write.mode("overwrite").parquet(raw)
    answers = spark.read.parquet(raw)
    skipped = Skipped((r["appid"], r["error"]) for r in answers.where("error is not null").select("appid", "error").collect())
    if len(skipped) == len(set(ids)):
        raise StoreError(f"{feed}: all of {len(skipped)} games failed, the first with {next(iter(skipped.values()))}")
    return answers.where("error is null").drop("error"), skipped


def _ids(targets: DataFrame, what: str) -> list[int]:
    """Ids of the targets: the store's catalogue bounds them."""
    ids = [r["appid"] for r in targets.select("appid").collect()]
    if not ids:
        raise ValueError(f"no games to crawl: {what}")
    return ids


def crawl_prices(spark: SparkSession, api: StoreApi, bronze: str, run: date, clock: str = "0000", **options) -> None:
    """The answer of the standing discount query as one object."""
    write_text(spark, json.dumps(api.discounted(**options), ensure_ascii=False), f"{bronze}/discount_games/{run:%Y%m%d}_{clock}.json")


def crawl_players(spark: SparkSession, tracked: DataFrame, bronze: str, run: date, clock: str = "0000", **options: str) -> Skipped:
    """Player counts of all active games as one object; games without an answer are left out."""
    ids = _ids(crawl_targets(tracked, "collect_players", newest_first=False), "players")
    counts, skipped = _feed(spark, "players", ids, f"{bronze}/players_raw/{run:%Y%m%d}_{clock}", options)
    write_json(counts.where("player_count is not null"), f"{bronze}/player_counts/{run:%Y%m%d}_{clock}.json")
    return skipped


def crawl_details(spark: SparkSession, tracked: DataFrame, bronze: str, run: date, limit: int | None = None, **options: str) -> Skipped:
    """Flattened details of the games; unanswered ones are left out."""
    ids = _ids(crawl_targets(tracked, newest_first=False, limit=limit), "details")
    answers, skipped = _feed(spark, "details", ids, f"{bronze}/details_raw/{run:%Y%m%d}", options)
    write_parquet(silver.flatten_details(answers), f"{bronze}/appdetails/{run:%Y%m%d}/details.parquet")
    return skipped


def interval(before: dict[str, str], after: dict[str, str]) -> str:
    """Name of a chunk: digests of the cursors that it starts from and ends at."""
    digest = lambda cursors: hashlib.sha256(json.dumps(cursors, sort_keys=True).encode()).hexdigest()[:16]
    return f"{digest(before)}-{digest(after)}"


def crawl_reviews(spark: SparkSession, tracked: DataFrame, bronze: str, run: date, limit: int | None = None, change: Change | None = None, **options: str) -> tuple[DataFrame, Skipped]:
    """Reviews behind the control table's cursors as a chunk of rows of the review schema; returns the control table with the cursors to go on from,
    and the games that failed (what came before a failure is kept, with its cursor).

    A chunk is named by the cursors between which it lies and never overwrites another. With ``change`` the chunk is staged there, so that the caller
    commits it together with the control table: then a crawl that dies leaves both as they were, and the next one fetches the same pages again.
    """
    targets = crawl_targets(tracked, "collect_reviews", limit=limit)
    rows = targets.select("appid", F.to_json("review_cursors").alias("c")).collect()
    if not rows:
        raise ValueError("no games to crawl: reviews")
    cursors = {f"{r['appid']}/{language}": cursor for r in rows if r["c"] for language, cursor in json.loads(r["c"]).items()}
    own = change is None
    change = Journal(spark, bronze).begin() if own else change
    raw, parsed = change.folder("reviews_raw"), change.folder("reviews")
    answers, skipped = _feed(spark, "reviews", [r["appid"] for r in rows], raw, {**options, "cursors": json.dumps(cursors)})
    last = lambda df: df.groupBy("appid", "language").agg(F.max_by("cursor", "page").alias("cursor"))
    ends = {f"{r['appid']}/{r['language']}": r["cursor"] for r in last(answers).collect()}
    if ends:
        write_parquet(silver.parse_reviews(answers), parsed)
        name, files = interval(cursors, {**cursors, **ends}), change.journal.files
        chunk = lambda kind, i: f"{bronze}/{kind}/{run:%Y%m%d}/reviews.parquet/chunk={name}" + f"-{i}" * bool(i)
        # A last page that answers with its own cursor may be fetched again, under the same name.
        free = next(i for i in range(1_000_000) if not files.exists(chunk("reviews", i)))
        change.move(raw, chunk("reviews_raw", free))
        change.move(parsed, chunk("reviews", free))
        if own:
            change.commit()
            answers = spark.read.parquet(chunk("reviews_raw", free)).where("error is null")
    return silver.merge_cursors(tracked, last(answers)), skipped
