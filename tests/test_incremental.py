"""Crawls, lake, facts and tokens that change only what is touched: against full rebuilds, and broken off at every step."""

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from vitrine import schemas as S
from vitrine.operators.journal import Files, Journal
from vitrine.plans import gold, silver
from vitrine.plans.lake import ReviewIndex
from vitrine.plans.pipeline import Storefront
from vitrine.sources.store_feed import StoreApi, replay_transport

from test_crawl import recorded

DAY = date(2025, 4, 9)
AUTHOR = ("s", 60, 30, 0, 1, 1)


class Broken(Exception):
    pass


def breaking(monkeypatch, at):
    """Breaks off before the ``at``-th change of the store; returns the steps seen."""
    seen = []

    def step(self, what):
        if len(seen) == at:
            raise Broken(what)
        seen.append(what)

    monkeypatch.setattr(Files, "step", step)
    return seen


def content(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(str(path)).collect())


def test_journal_at_every_step(spark, tmp_path, monkeypatch):
    """Two tables and some partitions change together, wherever the writer dies; what is dropped goes, other partitions keep their files."""
    old, new = spark.range(3), spark.range(10, 14)
    parts = lambda n, *days: spark.createDataFrame([(n, d) for d in days], "v int, day string")
    at = done = 0
    while not done:
        root = tmp_path / str(at)
        journal = Journal(spark, str(root))
        change = journal.begin()
        change.replace(old, f"{root}/a")
        change.replace_partitions(parts(1, "x", "y", "z"), f"{root}/b", ["day"])
        change.commit()
        kept = sorted(p.name for p in (root / "b/day=x").iterdir())
        with monkeypatch.context() as m:
            seen = breaking(m, at)
            try:
                change = journal.begin()
                change.replace(new, f"{root}/a")
                change.replace_partitions(parts(2, "y", "w"), f"{root}/b", ["day"], dropped=["day=z", "day=y"])
                change.commit()
                done = True
            except Broken:
                pass
        committed = any(s.startswith("rename") and s.endswith(".json.part") for s in seen)
        if committed and not done:
            # A second writer that dies as well, one step later.
            with monkeypatch.context() as m:
                breaking(m, 1)
                try:
                    journal.recover()
                except Broken:
                    pass
        journal.recover()
        assert content(spark, root / "a") == content_of(new if committed else old)
        assert content(spark, root / "b") == ([(1, "x"), (2, "w"), (2, "y")] if committed else [(1, "x"), (1, "y"), (1, "z")])
        assert sorted(p.name for p in (root / "b/day=x").iterdir()) == kept
        assert not journal.pending() and not (root / "_staged").exists()
        at += 1
    assert at > 8


def content_of(df):
    return sorted(tuple(r) for r in df.collect())


def page_setup(folder):
    _, put, page, review = recorded(folder)
    put(*page(1, "english", "c2"), {"success": 1, "reviews": [review(500)], "cursor": "c3"})
    put(*page(1, "english", "c3"), {"success": 1, "reviews": []})
    return put, page, review


def test_crawls_of_one_day(spark, tmp_path):
    """Three crawls before one run: nothing is overwritten, and nothing is double; a chunk is named by its cursors."""
    folder = tmp_path / "answers"
    folder.mkdir()
    _, put, page, review = recorded(folder)
    shop = Storefront(spark, str(tmp_path / "bronze"), str(tmp_path / "wh"), index_buckets=4)
    api, options = StoreApi(replay_transport(str(folder)), lambda s: None), {"fixtures": str(folder), "languages": "english,korean", "workers": "2"}
    assert shop.crawl(DAY, api, **options).colour == "green"
    put(*page(1, "english", "c2"), {"success": 1, "reviews": [review(500)], "cursor": "c3"})
    put(*page(1, "english", "c3"), {"success": 1, "reviews": []})
    assert shop.crawl(DAY, api, **options).colour == "green"
    assert shop.crawl(DAY, api, **options).colour == "green"
    chunks = sorted(p.name for p in (tmp_path / "bronze/reviews/20250409/reviews.parquet").iterdir())
    assert len(chunks) == 2 and {c[6:22] for c in chunks} & {c[23:39] for c in chunks}  # one ends where the other begins
    assert len(list((tmp_path / "bronze/player_counts").glob("*.json"))) == 3
    report = shop.run(DAY)
    assert report.colour == "green", report
    ids = [r["recommendationid"] for r in spark.read.parquet(str(tmp_path / "wh/reviews")).collect()]
    assert len(ids) == 152 and set(ids) == {str(i) for i in (*range(151), 500)}
    assert {r["review_count"] for r in shop.table("fact_review_daily").collect()} == {152}


def test_crawl_at_every_step(spark, tmp_path, monkeypatch):
    """A crawl of reviews that dies at any step: the next ones bring every review once, and cursors never pass what is stored."""
    folder = tmp_path / "answers"
    folder.mkdir()
    page_setup(folder)
    at, done = 0, False
    options = {"fixtures": str(folder), "languages": "english", "workers": "1"}
    tracked = spark.createDataFrame([(1, DAY, DAY, True, True, True, None, {})], S.TRACKED_GAMES)
    while not done:
        root = tmp_path / str(at)
        shop = Storefront(spark, f"{root}/bronze", f"{root}/wh", index_buckets=4)
        shop.save("tracked_games", tracked)

        def crawl(shop=shop, root=root):
            from vitrine.plans import bronze

            change = shop.journal.begin()
            after, _ = bronze.crawl_reviews(spark, shop.table("tracked_games"), f"{root}/bronze", DAY, change=change, **options)
            change.replace(after, shop.path("tracked_games"))
            change.commit()

        with monkeypatch.context() as m:
            breaking(m, at)
            try:
                crawl()
                done = True
            except Broken:
                pass
        cursors = shop.table("tracked_games").first()["review_cursors"]
        stored = root / "bronze/reviews/20250409/reviews.parquet"
        assert stored.exists() == bool(cursors) and (not cursors or cursors == {"english": "c3"})
        crawl()
        assert len([p for p in stored.iterdir() if p.name.startswith("chunk=")]) == 1
        rows = [r[0] for r in spark.read.schema(S.REVIEWS).parquet(str(stored)).select("recommendationid").collect()]
        assert len(set(rows)) == 152 and shop.table("tracked_games").first()["review_cursors"] == {"english": "c3"}
        at += 1
    assert at > 5


# ---- the lake


def one(i, app, lang, at=1744185600, upd=1, text="Great story", played=30):
    return (str(i), ("s", 2 * played if played is not None else None, played, 0, 1, 1), lang, text, at, upd, True, 1, 0, "0.5", True, False, False, app)


def put(spark, bronze, day, *rows):
    spark.createDataFrame(list(rows), S.REVIEWS).coalesce(1).write.mode("overwrite").parquet(f"{bronze}/reviews/{day:%Y%m%d}/a.parquet")


def test_index(spark, tmp_path):
    """Reviews that the lake has are found with their last partition, others are not; filters keep buckets from being read; generations stay few."""
    journal, index = Journal(spark, str(tmp_path)), ReviewIndex(spark, str(tmp_path / "ix"), buckets=16)
    rng, have = random.Random(4), {}
    kinds = "appid int, recommendationid string, language string, year int, month int"
    for load in range(5):
        rows = {(rng.randrange(5), str(rng.randrange(4000))): (rng.choice(["english", None]), 2025, load + 1) for _ in range(rng.choice([1, 40, 300]))}
        change = journal.begin()
        index.add(change, spark.createDataFrame([(*k, *v) for k, v in rows.items()], kinds))
        change.commit()
        have |= rows
    asked = list(have)[:200] + [(9, str(i)) for i in range(100)]
    found = {(r[0], r[1]): tuple(r)[2:] for r in index.lookup(spark.createDataFrame(asked, "appid int, recommendationid string")).collect()}
    assert found == {k: have[k] for k in asked if k in have}
    assert len(index.generations()) <= 4
    assert sum(g.rows for g in index.generations()) <= 2 * len(have)
    assert index.lookup(spark.createDataFrame([(7, "a"), (7, "b")], "appid int, recommendationid string")).count() == 0
    assert len(index.read) <= 1  # a filter may err, seldom
    index.lookup(spark.createDataFrame([asked[0]], "appid int, recommendationid string")).collect()
    assert 1 <= len(index.read) <= 2


def test_index_asks_no_filter_for_many(spark, tmp_path, monkeypatch):
    """Of a bucket that more reviews fall into than ``most_asked`` all entries are read, and no filter is asked; what is found is the same."""
    kind = "appid int, recommendationid string"
    journal, index = Journal(spark, str(tmp_path)), ReviewIndex(spark, str(tmp_path / "ix"), buckets=4)
    for first in (0, 300):
        change = journal.begin()
        index.add(change, spark.createDataFrame([(1, str(i), "english", 2025, 4) for i in range(first, first + 200)], f"{kind}, language string, year int, month int"))
        change.commit()
    asked = spark.createDataFrame([(1, str(i)) for i in range(100, 400)], kind)
    expected = sorted(tuple(r) for r in index.lookup(asked).collect())
    assert [r[1] for r in expected] == sorted(str(i) for i in range(100, 400) if not 200 <= i < 300)
    asks, hits = [], ReviewIndex._hits
    monkeypatch.setattr(ReviewIndex, "_hits", lambda self, generations, ids: asks.append(ids.count()) or hits(self, generations, ids))
    per_bucket = [r["n"] for r in asked.groupBy(F.pmod(F.xxhash64("appid", "recommendationid"), F.lit(4))).agg(F.count("*").alias("n")).collect()]
    for most, left in ((0, []), (min(per_bucket), [min(per_bucket)]), (max(per_bucket), [300])):
        index.most_asked = most
        assert sorted(tuple(r) for r in index.lookup(asked).collect()) == expected
        assert asks == left
        asks.clear()


def test_load_reads_what_it_touches(spark, tmp_path):
    """New reviews of one game: no index bucket and one partition of the lake are read; a moved review adds its bucket and the partition that it leaves."""
    bronze, shop = tmp_path / "bronze", Storefront(spark, str(tmp_path / "bronze"), str(tmp_path / "wh"), index_buckets=4)
    put(spark, bronze, DAY, *[one(1000 * app + i, app, lang) for app in range(1, 6) for lang in ("english", "koreana") for i in range(20)])
    shop.load_reviews(DAY)
    put(spark, bronze, date(2025, 4, 10), one(77777, 1, "english"), one(77778, 1, "english"))
    shop.load_reviews(date(2025, 4, 10))
    assert shop.lake.index.read == [] and shop.lake.read == ["appid=1/language=english/year=2025/month=04"]
    put(spark, bronze, date(2025, 4, 11), one(2003, 2, "koreana", upd=9), one(4004, 4, "german", upd=9))
    shop.load_reviews(date(2025, 4, 11))
    assert 1 <= len(shop.lake.index.read) <= 4 and len(shop.lake.read) <= 3
    assert {r["language"] for r in shop.lake.rows().where("recommendationid = '4004'").collect()} == {"german"}


def test_new_reviews_are_not_sorted_again(spark, tmp_path, monkeypatch):
    """Lake and load are brought together by review only where the lake has earlier rows, or where ids are null; the rows are the same."""
    bronze, shop, merges = tmp_path / "bronze", Storefront(spark, str(tmp_path / "bronze"), str(tmp_path / "wh"), index_buckets=4), []
    merge = silver.merge_reviews
    monkeypatch.setattr(silver, "merge_reviews", lambda lake, fresh: (merges.append(lake is not None), merge(lake, fresh))[1])

    def load(day, *rows):
        put(spark, bronze, date(2025, 4, day), *rows)
        merges.clear()
        shop.load_reviews(date(2025, 4, day))
        return any(merges), sorted((r["recommendationid"] or "", r["review"]) for r in shop.lake.rows().collect())

    assert load(1, one(1, 1, "english", text="a"), one(1, 1, "english", upd=2, text="b")) == (False, [("1", "b")])
    assert load(2, one(2, 1, "english", text="c")) == (False, [("1", "b"), ("2", "c")])
    assert load(3, one(2, 1, "english", upd=3, text="d"), one(3, 1, "english", text="e")) == (True, [("1", "b"), ("2", "d"), ("3", "e")])
    shop.add_reviews(spark.read.schema(S.REVIEWS).parquet(f"{bronze}/reviews/20250403").withColumn("recommendationid", F.lit(None).cast("string")))
    assert any(merges)


def facts(shop):
    daily = {tuple(r)[:3]: r["review_count"] for r in shop.table("fact_review_daily").collect()}
    played = {tuple(r)[:3]: tuple(r)[3:6] for r in shop.table("fact_review_playtime_daily").collect()}
    tokens = {(r["app_id"], r["language"], r["morpheme"]): tuple(r)[3:7] for r in shop.table("gold_review_morphemes").collect()}
    return daily, played, tokens


def rebuilt(spark, shop, versions):
    """What the last versions of all reviews give by a full count."""
    rows = spark.createDataFrame(list(versions.values()), S.REVIEWS)
    active = shop.table("tracked_games").where("is_active").select(F.col("appid"))
    lake = silver.clean_reviews(rows).withColumn("language", F.nullif(F.col("language"), F.lit(""))).join(active, "appid", "left_semi")
    daily = {tuple(r)[:3]: r["review_count"] for r in silver.review_daily(lake).collect()}
    played = {tuple(r)[:3]: tuple(r)[3:6] for r in silver.review_playtime_daily(lake).collect()}
    tokens = {(r["app_id"], r["language"], r["morpheme"]): tuple(r)[3:7] for r in gold.english_review_tokens(lake, 3).collect()}
    return daily, played, tokens


@pytest.mark.parametrize("seed", [2])
def test_random_histories(spark, tmp_path, seed):
    """Inserts, repeats, moves between languages, months and days, and games that stop and start being active: always equal to a full count."""
    rng = random.Random(seed)
    bronze, shop = tmp_path / "bronze", Storefront(spark, str(tmp_path / "bronze"), str(tmp_path / "wh"), index_buckets=4)
    versions, active = {}, {1, 2, 3}
    for load in range(3):
        rows = {}
        for _ in range(rng.choice([3, 25])):
            i, app = rng.randrange(40), rng.randrange(1, 4)
            known = versions.get((app, str(i)))
            row = one(i, app, rng.choice(["english", "koreana", "", None]), 1744185600 + 86400 * rng.randrange(-20, 40), load + 1, rng.choice(["good fun story", "bad bad ending", "gg", None]), rng.choice([None, 7, 30]))
            if known and rng.random() < 0.2:
                row = known  # a repeat
            rows[(app, str(i))] = row
        versions |= rows
        if load:
            active ^= {rng.choice([1, 2, 3])}
        shop.save("tracked_games", spark.createDataFrame([(a, DAY, DAY, a in active, True, True, None, {}) for a in (1, 2, 3)], S.TRACKED_GAMES))
        day = date(2025, 5, 1 + load)
        put(spark, bronze, day, *rows.values())
        shop.load_reviews(day)
        shop.load_review_facts()
        shop.load_tokens(3)
        got, want = facts(shop), rebuilt(spark, shop, versions)
        assert all({k: v for k, v in g.items() if k[0] in active} == w for g, w in zip(got, want))
    assert sorted(k for k in versions) == sorted((r["appid"], r["recommendationid"]) for r in shop.lake.rows().collect())


def test_load_at_every_step(spark, tmp_path, monkeypatch):
    """A load that dies on its way, and is repeated: lake, index and lists of what was touched change together."""
    rows = [one(i, 1 + i % 2, "english") for i in range(6)]
    moved = [one(0, 1, "german", upd=5), one(9, 1, "english")]
    for at in (9,):
        root = tmp_path / str(at)
        shop = Storefront(spark, f"{root}/bronze", f"{root}/wh", index_buckets=4)
        shop.save("tracked_games", spark.createDataFrame([(a, DAY, DAY, True, True, True, None, {}) for a in (1, 2)], S.TRACKED_GAMES))
        put(spark, f"{root}/bronze", DAY, *rows)
        shop.load_reviews(DAY)
        shop.load_review_facts()
        put(spark, f"{root}/bronze", date(2025, 4, 10), *moved)
        with monkeypatch.context() as m:
            breaking(m, at)
            try:
                shop.load_reviews(date(2025, 4, 10))
                shop.load_review_facts()
            except Broken:
                pass
        shop.load_reviews(date(2025, 4, 10))
        shop.load_review_facts()
        assert {tuple(r)[:2] + (r["review_count"],) for r in shop.table("fact_review_daily").collect()} == {(1, "english", 3), (1, "german", 1), (2, "english", 3)}
        assert sorted(r["recommendationid"] for r in shop.lake.rows().collect()) == sorted([*map(str, range(6)), "9"])


def test_other_days_keep_their_files(spark, tmp_path):
    """Facts: prices, players, counts and tokens of other days and groups are not written again."""
    bronze, wh = tmp_path / "bronze", tmp_path / "wh"
    shop = Storefront(spark, str(bronze), str(wh), index_buckets=4)
    for d in ("discount_games", "player_counts"):
        (bronze / d).mkdir(parents=True)

    def feeds(day, cents):
        item = {"appid": 1, "name": "x", "best_purchase_option": {"original_price_in_cents": "2900", "final_price_in_cents": cents, "discount_pct": 50}}
        (bronze / "discount_games" / f"{day:%Y%m%d}_1.json").write_text(json.dumps({"response": {"ids": [{"appid": 1}, {"appid": 2}], "store_items": [item] if cents else []}}))
        (bronze / "player_counts" / f"{day:%Y%m%d}_1.json").write_text(json.dumps([{"appid": 1, "player_count": 5, "collected_at": f"{day}T08:00:00+00:00"}]))

    def load(day, *rows):
        put(spark, bronze, day, *rows)
        note = shop.load_prices(day)
        shop.load_players(day)
        shop.load_reviews(day)
        shop.load_review_facts()
        shop.load_tokens()
        return note

    feeds(DAY, "100")
    assert load(DAY, one(1, 1, "english"), one(2, 2, "english"), one(3, 1, "english", at=1744099200)) is None
    names = lambda table: {str(p.parent.relative_to(wh / table)): p.name for p in (wh / table).rglob("*.parquet")}
    tables = ("fact_price_history", "fact_concurrent_players", "fact_review_daily", "fact_review_playtime_daily", "gold_review_morphemes")
    before = {t: names(t) for t in tables}
    next_day = date(2025, 4, 10)
    feeds(next_day, "")
    assert load(next_day, one(4, 1, "english", at=1744272000, text="Nice ending")) == "the day's answer has no items"
    after = {t: names(t) for t in tables}
    for t in tables[1:4]:
        assert set(after[t]) - set(before[t]) == {"day=2025-04-10"} and all(after[t][k] == v for k, v in before[t].items())
    assert after["fact_price_history"] == before["fact_price_history"]
    gold_before, gold_after = before["gold_review_morphemes"], after["gold_review_morphemes"]
    assert gold_after["game=2/lang=english"] == gold_before["game=2/lang=english"] and gold_after["game=1/lang=english"] != gold_before["game=1/lang=english"]
    assert {(r["morpheme"], r["frequency"]) for r in shop.table("gold_review_morphemes").where("app_id = 1").collect()} == {("great", 2), ("story", 2), ("nice", 1), ("ending", 1)}
    load(next_day, one(4, 1, "english", at=1744272000, text="Nice ending"))  # the same again
    assert {t: names(t) for t in tables[2:4]} == {t: after[t] for t in tables[2:4]}


def test_late_rows_are_corrections(spark, tmp_path, monkeypatch):
    """A stream in disorder, broken off on its way and started again: closed and open days and corrections add up to the batch count."""
    from vitrine.streaming.corrections import DailyCounts

    rng = random.Random(8)
    events = [(rng.choice([1, 2, None]), f"2025-01-{d + 1:02d} {rng.randrange(24):02d}:00:00") for d in range(12) for _ in range(3)] + [(1, None)]
    folder = tmp_path / "in"
    order = sorted(range(len(events)), key=lambda i: i + rng.randrange(20))
    for k in range(0, len(order), 13):
        rows = spark.createDataFrame([events[i] for i in order[k : k + 13]], "k int, t string").select("k", F.col("t").cast("timestamp").alias("t"))
        rows.coalesce(1).write.mode("append").parquet(str(folder))
    root = tmp_path / "counts"

    def run():
        counts = DailyCounts(spark, str(root), "k", "t", 2)
        stream = spark.readStream.schema("k int, t timestamp").option("maxFilesPerTrigger", 1).parquet(str(folder))
        query = stream.writeStream.foreachBatch(counts).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        return counts

    with monkeypatch.context() as m:
        breaking(m, 9)
        with pytest.raises(Exception, match="Broken|rename|delete|write"):
            run()
    counts = run()
    want = {}
    for k, t in events:
        if t:
            want[k, t[:10]] = want.get((k, t[:10]), 0) + 1
    assert {(r["key"], str(r["day"])): r["n"] for r in counts.totals().collect()} == want
    closed, late = counts.closed().collect(), counts.corrections().collect()
    assert closed and late and {r["day"] for r in late} <= {date(2025, 1, d) for d in range(1, 11)}
    assert not {r["day"] for r in closed} & {r["day"] for r in counts.open().collect()}


def test_trends_are_refreshed_where_they_change(spark, tmp_path):
    """Random changes of player counts and prices, with gaps between a game's days: the mart equals one that is built whole, and few days are read."""
    from vitrine.plans import marts, staging

    rng = random.Random(11)
    shop = Storefront(spark, str(tmp_path / "bronze"), str(tmp_path / "wh"), index_buckets=4)
    games = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "app_id int, name string")
    day = lambda i: date.fromordinal(date(2025, 1, 1).toordinal() + i)
    all_days = [(app, i) for app, step in ((1, 1), (2, 4), (3, 1)) for i in range(0, 90, step)]

    def load(rows, prices=()):
        change = shop.journal.begin()
        counts = spark.createDataFrame([(app, n, f"{day(i)}T08:00:00+00:00") for app, i, n in rows], S.PLAYER_COUNTS)
        shop.merge_days(change, "fact_concurrent_players", silver.player_rows(counts), silver.merge_player_rows)
        if prices:
            shop.merge_days(change, "fact_price_history", spark.createDataFrame([(app, "KRW", 2, 1, pct, False, None, day(i)) for app, i, pct in prices], S.FACT_PRICE), silver.merge_prices)
        change.commit()
        s = shop.staged()
        read = shop.refresh_trend("mart_discount_player_trend", s["stg_price_history"], games)
        got = spark.read.parquet(shop.path("mart_discount_player_trend")).drop("day")
        want = marts.mart_discount_player_trend(staging.stg_concurrent_players(shop.table("fact_concurrent_players")), s["stg_price_history"], games)
        assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
        return read

    assert len(load([(app, i, rng.randrange(100)) for app, i in all_days if i != 50])) > 80
    assert len(load([(1, 60, 500)])) <= 1 + 2 * 7 + 1
    assert load([(3, 50, 5), (1, 50, 7)], [(1, 50, 30), (2, 48, 10)])
    before = {p.parent.name: p.name for p in (tmp_path / "wh/mart_discount_player_trend").rglob("*.parquet")}
    assert load([(2, 20, 77)], [(2, 21, 40)])  # this game's rows lie four days apart
    after = {p.parent.name: p.name for p in (tmp_path / "wh/mart_discount_player_trend").rglob("*.parquet")}
    changed = {k for k in after if before.get(k) != after[k]}
    assert changed == {f"day={day(i)}" for i in (*range(20, 52, 4), 21)} - {f"day={day(52)}"} and len(changed) <= 10
