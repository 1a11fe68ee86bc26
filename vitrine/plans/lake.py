"""The review lake: merges that read and write only what a load touches.

An index tells in which partition of the lake each review lies. It is a list of generations, each written once by one load; a generation has its
entries and Bloom filters by bucket of the review's hash. Generations of like size are merged, so there are some log(loads) of them and an entry is
rewritten some log(loads) times. A load asks the filters first: reviews that no filter knows are new, and of the entries only buckets with a hit are read.
A bucket that very many of a load's reviews fall into is read without asking: some filter would err for one of them (one review in a hundred).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import latest_per_key
from ..operators.journal import Change, Files
from ..schemas import REVIEWS
from . import silver

ID = ["appid", "recommendationid"]


@dataclass(frozen=True)
class Generation:
    name: str
    rows: int
    bits: int

    @classmethod
    def of(cls, name: str) -> Generation:
        _, rows, bits = name.split("-")
        return cls(name, int(rows), int(bits))


@dataclass
class ReviewIndex:
    """Entries ``appid, recommendationid, language, year, month`` at ``path/<number>-<rows>-<bits of a filter>/{entries,filters}/bucket=N``."""

    spark: SparkSession
    path: str
    buckets: int = 64
    hashes: int = 5
    bits_per_row: int = 10
    #: Of a bucket with more reviews than this no filter is asked: all would say no with a chance of 1 in 12,000 (0.9906 ** 1000).
    most_asked: int = 1000
    #: Folders that the last :meth:`lookup` read.
    read: list[str] = field(default_factory=list)

    ENTRY = "appid INT, recommendationid STRING, language STRING, year INT, month INT, bucket INT"

    def generations(self) -> list[Generation]:
        """Oldest first."""
        return [Generation.of(n) for n in Files(self.spark, self.path).names(self.path)]

    def _hash(self) -> Column:
        return F.xxhash64(*ID)

    def _places(self, bits: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.lit(self.hashes)), lambda i: F.pmod(F.xxhash64(F.col("__h"), i), bits))

    def _filters(self, entries: DataFrame, bits: int) -> DataFrame:
        places = entries.select("bucket", self._hash().alias("__h")).select("bucket", F.explode(self._places(F.lit(bits))).alias("p"))
        return places.groupBy("bucket", F.shiftright("p", 6).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("p", F.lit(64)).cast("int"))).alias("set"))

    def lookup(self, ids: DataFrame) -> DataFrame:
        """Entries of those of the reviews (``appid, recommendationid``, each once) that the lake has."""
        generations, files = self.generations(), Files(self.spark, self.path)
        self.read = []
        if generations:
            asked = ids.select(*ID, self._hash().alias("__h")).withColumn("bucket", F.pmod("__h", F.lit(self.buckets)).cast("int"))
            counts = {r["bucket"]: r["n"] for r in asked.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
            full = [b for b, n in counts.items() if n > self.most_asked]
            # At most the number of generations times that of buckets.
            hits = {(g.name, b) for g in generations for b in full}
            if len(full) < len(counts):
                hits |= self._hits(generations, asked.where(~F.col("bucket").isin(full)))
            self.read = [f"{self.path}/{gen}/entries/bucket={bucket}" for gen, bucket in sorted(hits)]
            self.read = [p for p in self.read if files.exists(p)]
        if not self.read:
            return self.spark.createDataFrame([], self.ENTRY).drop("bucket")
        rows = self._entries(self.read)
        return self._latest(rows.join(ids.select(*ID), ID, "left_semi"))

    def _hits(self, generations: list[Generation], asked: DataFrame) -> set[tuple[str, int]]:
        """Generations and buckets whose filters know a review of ``asked`` (``__h``, ``bucket``), which has at most ``most_asked`` of a bucket."""
        each = F.explode(F.array(*[F.struct(F.lit(g.name).alias("gen"), F.lit(g.bits).cast("bigint").alias("bits")) for g in generations]))
        probes = asked.select("__h", "bucket", each.alias("g")).select("__h", "bucket", "g.gen", F.explode(self._places(F.col("g.bits"))).alias("p"))
        probes = probes.select("__h", "bucket", "gen", F.shiftright("p", 6).cast("int").alias("word"), F.pmod("p", F.lit(64)).cast("int").alias("bit"), "p").distinct()
        filters = None
        for g in generations:
            own = self.spark.read.schema("word INT, set BIGINT, bucket INT").parquet(f"{self.path}/{g.name}/filters").withColumn("gen", F.lit(g.name))
            filters = own if filters is None else filters.unionByName(own)
        hit = probes.join(filters, ["gen", "bucket", "word"], "left").withColumn("on", F.coalesce(F.call_function("shiftright", F.col("set"), F.col("bit")).bitwiseAND(F.lit(1)) == 1, F.lit(False)))
        known = hit.groupBy("gen", "bucket", "__h").agg(F.min("on").alias("on")).where("on").select("gen", "bucket").distinct()
        return {(r["gen"], r["bucket"]) for r in known.collect()}

    def _entries(self, paths: list[str]) -> DataFrame:
        read = self.spark.read.schema(self.ENTRY.rsplit(",", 1)[0]).option("recursiveFileLookup", True)
        return read.parquet(*paths).withColumn("__gen", F.col("_metadata.file_path"))

    def _latest(self, rows: DataFrame) -> DataFrame:
        """Of entries of one review the last generation's; names of generations sort by their number."""
        number = F.regexp_extract("__gen", r"/(\d{9})-\d+-\d+/", 1)
        return latest_per_key(rows.withColumn("__n", number), ID, ["__n"]).drop("__n", "__gen")

    def add(self, change: Change, entries: DataFrame) -> None:
        """Stages a generation of the entries, merged with the newest ones as long as these are at most twice as large."""
        entries = entries.select(*ID, "language", F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"))
        staged = change.folder(f"index-{uuid.uuid4().hex[:8]}")
        entries.write.parquet(f"{staged}/new")
        own = self.spark.read.schema(entries.schema).parquet(f"{staged}/new")
        rows, merged, generations = own.count(), [], self.generations()
        if not rows:
            return
        while generations and generations[-1].rows <= 2 * rows:
            merged.append(generations.pop())
            rows += merged[-1].rows
        number = max([0, *(int(g.name.split("-")[0]) for g in [*merged, *generations])]) + 1
        if merged:
            older = self._entries([f"{self.path}/{g.name}/entries" for g in merged])
            own = self._latest(own.withColumn("__gen", F.lit(f"/{number:09d}-0-0/")).unionByName(older))
        own.withColumn("bucket", F.pmod(self._hash(), F.lit(self.buckets)).cast("int")).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{staged}/gen/entries")
        kept = self.spark.read.schema(self.ENTRY).parquet(f"{staged}/gen/entries")
        bits = max(64, rows * self.bits_per_row // self.buckets)
        self._filters(kept, bits).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{staged}/gen/filters")
        change.move(f"{staged}/gen", f"{self.path}/{number:09d}-{rows}-{bits}")
        for g in merged:
            change.drop(f"{self.path}/{g.name}")


@dataclass
class ReviewLake:
    """Hive layout ``appid=/language=/year=/month=MM`` below ``root/reviews``, its index, and lists of partitions that consumers have not yet seen."""

    spark: SparkSession
    root: str
    buckets: int = 64
    #: Folders of the lake that the last :meth:`merge` read.
    read: list[str] = field(default_factory=list)

    CONSUMERS = ("facts", "tokens")
    PARTS = "appid INT, language STRING, year INT, month INT"

    def __post_init__(self):
        self.path = f"{self.root}/reviews"
        self.index = ReviewIndex(self.spark, f"{self.root}/reviews_index", self.buckets)
        self.files = Files(self.spark, self.root)

    def rows(self, folders: list[str] | None = None) -> DataFrame:
        """All rows, or those of some partitions; only these are listed then."""
        cleaned = silver.clean_reviews(self.spark.createDataFrame([], REVIEWS)).drop("appid", "language")
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cleaned.schema)
        if folders == [] or not self.files.exists(self.path):
            return self.spark.createDataFrame([], f"{kinds}, {self.PARTS}")
        paths = [self.path] if folders is None else [f"{self.path}/{f}" for f in folders]
        return self.spark.read.schema(f"{kinds}, {self.PARTS}").option("basePath", self.path).parquet(*paths)

    def folders(self, parts: DataFrame) -> list[str]:
        """Folders of partitions; as many as a load touches, and its commit moves them one by one."""
        escape, names = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName, {}

        def name(language: str | None) -> str:
            if language not in names:
                names[language] = escape(language) if language else "__HIVE_DEFAULT_PARTITION__"
            return names[language]

        return sorted({f"appid={r['appid']}/language={name(r['language'])}/year={r['year']}/month={r['month']:02d}" for r in parts.toLocalIterator()})

    def standing(self, folders: list[str]) -> list[str]:
        return [f for f in folders if self.files.exists(f"{self.path}/{f}")]

    def build_index(self, change: Change) -> None:
        """Stages an index of a lake that has none."""
        self.index.add(change, self.rows().select(*ID, "language", "year", "month"))

    def merge(self, change: Change, fresh: DataFrame) -> None:
        """Stages the lake with the rows of ``fresh`` (clean, dated) merged in by review: of several versions the one updated last stays. A review that
        has changed its language or month moves. Only partitions that rows go into, or leave, are read and replaced; those left empty go."""
        spark, staged = self.spark, change.folder(f"fresh-{uuid.uuid4().hex[:8]}")
        silver.merge_reviews(None, fresh).write.parquet(f"{staged}/rows")
        fresh = spark.read.parquet(f"{staged}/rows")
        self.index.lookup(fresh.select(*ID)).write.parquet(f"{staged}/held")
        held = spark.read.schema(f"appid INT, recommendationid STRING, {self.PARTS.split(', ', 1)[1]}").parquet(f"{staged}/held")
        parts = silver.touched_partitions(None, fresh).union(held.select(*silver.LAKE_PARTS)).distinct()
        touched = self.folders(parts)
        self.read = self.standing(touched)
        before = self.rows(self.read).drop("year", "month") if self.read else None
        merged = self._merged(before, fresh, held).withColumns({"year": F.col("review_year"), "month": F.lpad(F.col("review_month").cast("string"), 2, "0")})
        new = change.replace_partitions(merged, self.path, silver.LAKE_PARTS, dropped=touched)
        place = F.struct("language", "year", "month")
        now = spark.read.schema(self.rows([]).schema).parquet(new).select(*ID, "language", "year", "month").join(fresh.select(*ID), ID, "left_semi")
        moved = now.join(held.select(*ID, place.alias("__was")), ID, "left").where(~place.eqNullSafe(F.col("__was"))).drop("__was")
        self.index.add(change, moved)
        for consumer in self.CONSUMERS:
            parts.write.parquet(f"{staged}/{consumer}")
            change.move(f"{staged}/{consumer}", f"{self.root}/reviews_touched/{consumer}/{uuid.uuid4().hex}")

    @staticmethod
    def _merged(before: DataFrame | None, fresh: DataFrame, held: DataFrame) -> DataFrame:
        """``before`` and ``fresh`` have one row of each review. Only if the lake has earlier rows of fresh ones (or ids are null, which the index
        doesn't know) are they brought together by review; else they stand side by side, and their texts are not shuffled and sorted again."""
        if before is None:
            return fresh
        if held.isEmpty() and fresh.where("recommendationid is null").isEmpty():
            return before.unionByName(fresh, allowMissingColumns=True)
        return silver.merge_reviews(before, fresh)

    def touched(self, consumer: str) -> tuple[DataFrame, list[str]]:
        """Partitions touched since the consumer last took note, and the lists that it drops when it has."""
        top = f"{self.root}/reviews_touched/{consumer}"
        lists = [f"{top}/{n}" for n in self.files.names(top)]
        parts = self.spark.read.schema(self.PARTS).parquet(*lists).distinct() if lists else self.spark.createDataFrame([], self.PARTS)
        return parts, lists

    def parts_of(self, games: list[int]) -> DataFrame:
        """All partitions of some games."""
        paths = [f"appid={g}" for g in games if self.files.exists(f"{self.path}/appid={g}")]
        return self.rows(paths).select(*silver.LAKE_PARTS).distinct() if paths else self.spark.createDataFrame([], self.PARTS)


def changed_rows(old: DataFrame, new: DataFrame, keys: list[str], measures: list[str], day: str) -> DataFrame:
    """``app_id, day`` of rows that differ."""
    o = old.select(*keys, F.struct(*measures).alias("__o"))
    n = new.select(*keys, F.struct(*measures).alias("__n"))
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    both = o.alias("o").join(n.alias("n"), on, "full_outer").where(~F.col("__o").eqNullSafe(F.col("__n")))
    return both.select(F.coalesce("o.app_id", "n.app_id").alias("app_id"), F.coalesce(f"o.{day}", f"n.{day}").cast("string").alias("day")).where("day is not null").distinct()


def replace_days(change: Change, path: str, fact: DataFrame, fresh: DataFrame, parts: DataFrame, keys: list[str], day: str) -> DataFrame | None:
    """Stages a fact table, partitioned by ``day``, in which the rows of the lake's partitions ``parts`` are those of ``fresh``. Only days on which that
    changes anything are replaced, and rows that stay as they were keep their time of update. Returns ``app_id, day`` of what changed."""
    months = sorted({f"{r['year']}-{r['month']:02d}" for r in parts.select("year", "month").distinct().collect()})
    if not months:
        return None
    measures = [c for c in fresh.columns if c not in (*keys, "updated_at")]
    counted = change.folder(f"counted-{uuid.uuid4().hex[:8]}")
    fresh.write.parquet(counted)  # it is looked at twice, and counts the lake
    fresh = fact.sparkSession.read.schema(fresh.schema).parquet(counted)
    near = fact.where(F.substring("day", 1, 7).isin(months))
    p = parts.select(*[F.col(c).alias(f"__{c}") for c in silver.LAKE_PARTS])
    inside = (F.col("app_id") == F.col("__appid")) & F.col("language").eqNullSafe(F.col("__language")) & (F.year(day) == F.col("__year")) & (F.month(day) == F.col("__month"))
    staged = change.folder(f"changed-{uuid.uuid4().hex[:8]}")
    changed_rows(near.join(p, inside, "left_semi"), fresh, keys, measures, day).write.parquet(staged)
    changed = fact.sparkSession.read.parquet(staged)
    days = sorted(r["day"] for r in changed.select("day").distinct().collect())  # the calendar bounds them
    if not days:
        return None
    mine = near.where(F.col("day").isin(days))
    old = mine.select(*[F.col(k).alias(f"__{k}") for k in keys], F.struct(*measures).alias("__was"), F.col("updated_at").alias("__at"))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    stay = F.coalesce(F.struct(*measures).eqNullSafe(F.col("__was")), F.lit(False))
    renewed = fresh.where(F.col(day).cast("string").isin(days)).join(old, on, "left")
    renewed = renewed.select(*keys, *measures, F.when(stay, F.col("__at")).otherwise(F.col("updated_at")).alias("updated_at"), F.col(day).cast("string").alias("day"))
    rows = mine.join(p, inside, "left_anti").select(*renewed.columns).unionByName(renewed)
    change.replace_partitions(rows, path, ["day"], dropped=[f"day={d}" for d in days])
    return changed

