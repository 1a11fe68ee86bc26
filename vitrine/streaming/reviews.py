"""Streaming counterparts: daily counts over a file or feed stream, and draining a cursor feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from ..sources.store_feed import Notes, StoreFeedSource


def daily_counts_stream(events: DataFrame, key: str, ts: str, lateness: str = "2 days") -> DataFrame:
    """Tumbling days per key; the watermark bounds the state, later rows go to the batch recount."""
    return events.withWatermark(ts, lateness).groupBy(F.window(ts, "1 day").alias("day"), key).agg(F.count("*").alias("review_count")).select(key, F.to_date("day.start").alias("review_date"), "review_count")


def drain_reviews(spark: SparkSession, options: dict[str, str], out: str, checkpoint: str, most_batches: int = 1_000_000) -> int:
    """Append all pages of the review feed behind the kept cursors to ``out``, batch by batch, until no feed has more; returns the number of batches.

    Cursors are kept in the checkpoint's folder, which driver and executors must share."""
    ship(spark)
    spark.dataSource.register(StoreFeedSource)
    notes = Notes(f"{checkpoint}/cursors")
    for batch in range(1, most_batches + 1):
        feed = spark.readStream.format("store_feed").options(feed="reviews", **options, state=f"{checkpoint}/cursors").load()
        query = feed.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        if all(at[2:] for at in notes.read(notes.last_batch()).values()):
            return batch
    return most_batches


def last_cursors(checkpoint: str) -> dict[str, str]:
    """Cursors behind the last batch of :func:`drain_reviews` (for the control table)."""
    notes = Notes(f"{checkpoint}/cursors")
    return {target: at[0] for target, at in notes.read(notes.last_batch()).items()}
