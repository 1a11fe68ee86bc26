"""Daily counts of a stream whose late rows are corrections, not losses."""

from __future__ import annotations

import json
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.journal import Journal


class DailyCounts:
    """For ``foreachBatch``: counts by key and day, in three tables below ``root``.

    A day is open until an event of ``lateness`` days later has been seen. Then its counts are final for readers: they are written once, to ``closed``,
    and leave the state. Rows that come for a closed day are counted beside it, in ``corrections``, by batch. So closed and open days and corrections
    always add up to what a batch job would count over all rows, and the state is as large as the open days.

    All that a batch changes is one change of the journal, with the batch's number, so a batch that is run again after a crash changes nothing twice. Rows
    without a time are not counted; a null key is a key.
    """

    KINDS = "n BIGINT, day DATE"

    def __init__(self, spark: SparkSession, root: str, key: str, ts: str, lateness: int = 2):
        self.spark, self.root, self.key, self.ts, self.lateness = spark, root.rstrip("/"), key, ts, lateness
        self.journal = Journal(spark, self.root)
        self.kind = None

    def _mark(self) -> dict:
        """The last batch, the first day that is still open, and the type of the key."""
        if self.journal.pending():
            self.journal.recover()
        name = f"{self.root}/mark/mark.json"
        return json.loads(self.journal.files.read(name)) if self.journal.files.exists(name) else {"batch": -1, "open": None, "key": None}

    def _table(self, name: str, kind: str | None, folders: list[str] | None = None) -> DataFrame:
        path, kinds = f"{self.root}/{name}", f"key {kind or 'STRING'}, {self.KINDS}"
        if folders is not None:
            folders = [f for f in folders if self.journal.files.exists(f"{path}/{f}")]
        if not self.journal.files.exists(path) or folders == []:
            return self.spark.createDataFrame([], kinds)
        read = self.spark.read.schema(kinds).option("basePath", path)
        return read.parquet(*([path] if folders is None else [f"{path}/{f}" for f in folders]))

    def __call__(self, rows: DataFrame, batch: int) -> None:
        mark = self._mark()
        if batch <= mark["batch"]:
            return
        change = self.journal.begin()
        kind, staged = rows.schema[self.key].dataType.simpleString(), change.folder("counts")
        dated = rows.where(F.col(self.ts).isNotNull())
        dated.groupBy(F.col(self.key).alias("key"), F.to_date(self.ts).alias("day")).agg(F.count("*").alias("n")).write.parquet(staged)
        counts = self.spark.read.parquet(staged)
        days = sorted(r["day"] for r in counts.select("day").distinct().collect())  # the calendar bounds them
        first = date.fromisoformat(mark["open"]) if mark["open"] else None
        late = [d for d in days if first and d < first]
        bound = max([first, *([days[-1] - timedelta(self.lateness)] if days else [])], default=None, key=lambda d: d or date.min)
        if late:
            self._append(change, counts.where(F.col("day").isin(late)), f"corrections/batch={batch}")
        on_time = [d for d in days if d not in set(late)]
        standing = [date.fromisoformat(n.removeprefix("day=")) for n in self.journal.files.names(f"{self.root}/open") if n.startswith("day=")]
        closing = sorted(d for d in {*standing, *on_time} if bound and d < bound)
        touched = sorted({*on_time, *closing})
        before = self._table("open", kind, [f"day={d}" for d in touched])
        now = before.unionByName(counts.where(F.col("day").isin(on_time)).select("key", "n", "day")).groupBy("key", "day").agg(F.sum("n").alias("n"))
        if closing:
            change.replace_partitions(now.where(F.col("day").isin(closing)), f"{self.root}/closed", ["day"])
            for d in set(closing) & set(standing):
                change.drop(f"{self.root}/open/day={d}")
        if rest := [d for d in on_time if d not in set(closing)]:
            change.replace_partitions(now.where(F.col("day").isin(rest)), f"{self.root}/open", ["day"])
        folder = change.folder("mark")
        self.journal.files.fs.mkdirs(self.journal.files.path(folder))
        self.journal.files.write(f"{folder}/mark.json", json.dumps({"batch": batch, "open": str(bound) if bound else None, "key": kind}))
        change.move(folder, f"{self.root}/mark")
        change.commit()

    def _append(self, change, rows: DataFrame, name: str) -> None:
        staged = change.folder(name.replace("/", "-"))
        rows.select("key", "n", "day").write.parquet(staged)
        change.move(staged, f"{self.root}/{name}")

    def closed(self) -> DataFrame:
        return self._table("closed", self._mark()["key"])

    def open(self) -> DataFrame:
        return self._table("open", self._mark()["key"])

    def corrections(self) -> DataFrame:
        """``key, n, day, batch``."""
        kinds = f"key {self._mark()['key'] or 'STRING'}, {self.KINDS}, batch BIGINT"
        path = f"{self.root}/corrections"
        return self.spark.read.schema(kinds).parquet(path) if self.journal.files.exists(path) else self.spark.createDataFrame([], kinds)

    def totals(self) -> DataFrame:
        """What a batch count over all rows gives: ``key, day, n``."""
        every = self.closed().unionByName(self.open()).unionByName(self.corrections().drop("batch"))
        return every.groupBy("key", "day").agg(F.sum("n").alias("n"))
