"""From recorded answers of the store to marts, and what must not lose rows on the way."""

import json
import urllib.error
import urllib.request
from datetime import date

import pytest
from pyspark.sql import functions as F

from vitrine import schemas as S
from vitrine.operators import recover
from vitrine.operators.upsert import swap_in
from vitrine.plans import bronze, silver
from vitrine.plans.pipeline import Storefront
from vitrine.sources import read_bronze_json, write_json, write_text
from vitrine.sources.store_feed import StoreApi, StoreError, http_transport, replay_transport, request_key, request_url

DAY = date(2025, 4, 9)


def recorded(folder):
    def put(endpoint, params, answer):
        (folder / request_key(endpoint, params)).write_text(json.dumps(answer))

    asked = []
    StoreApi(lambda e, p: asked.append((e, p)) or {}).discounted()
    item = {"appid": 1, "name": "A", "best_purchase_option": {"original_price_in_cents": "2900", "final_price_in_cents": "1450", "discount_pct": 50, "active_discounts": [{"discount_end_date": 1735689600}]}}
    put(*asked[0], {"response": {"ids": [{"appid": 1}, {"appid": 2}], "store_items": [item]}})
    put("players", {"appid": 1}, {"response": {"result": 1, "player_count": 7}})
    put("players", {"appid": 2}, {"response": {"result": 42}})
    put("details", {"appids": 1, "cc": "kr", "l": "korean"}, {"1": {"success": True, "data": {"name": "A", "genres": [{"id": "2", "description": "RPG"}]}}})
    put("details", {"appids": 2, "cc": "kr", "l": "korean"}, {"2": {"success": False}})
    review = lambda i: {"recommendationid": str(i), "language": "english", "review": "Great story", "timestamp_created": 1744185600, "timestamp_updated": 1744185600 + i, "author": {"steamid": "s", "playtime_at_review": 30, "playtime_forever": 60}}
    page = lambda app, language, cursor: ("reviews", {"appid": app, "language": language, "cursor": cursor, "filter": "recent", "num_per_page": 100})
    put(*page(1, "english", "*"), {"success": 1, "reviews": [review(i) for i in range(150)], "cursor": "c1"})
    put(*page(1, "english", "c1"), {"success": 1, "reviews": [review(150), review(149)], "cursor": "c2"})
    put(*page(1, "english", "c2"), {"success": 1, "reviews": [], "cursor": "c2"})
    put(*page(1, "korean", "*"), {"success": 1, "reviews": [], "cursor": "*"})
    for language in ("english", "korean"):
        put(*page(2, language, "*"), {"success": 2})
    return asked[0][1], put, page, review


def test_from_answers_to_marts(spark, tmp_path):
    """All pages of reviews arrive, whatever their number; cursors are kept, and a second crawl goes on from them."""
    folder = tmp_path / "answers"
    folder.mkdir()
    request, put, page, review = recorded(folder)
    nested = json.loads(request["input_json"])
    assert nested["context"] == {"language": "korean", "country_code": "KR"} and set(nested["data_request"]) == {"include_basic_info", "include_all_purchase_options"}
    shop = Storefront(spark, str(tmp_path / "bronze"), str(tmp_path / "wh"))
    api, options = StoreApi(replay_transport(str(folder)), lambda s: None), {"fixtures": str(folder), "languages": "english,korean", "workers": "2"}
    crawled = shop.crawl(DAY, api, **options)
    assert crawled.colour == "green", crawled
    report = shop.run(DAY)
    assert report.colour == "green", report
    assert [(r["app_id"], r["final_price"]) for r in shop.table("fact_price_history").collect()] == [(1, 1450)]
    assert [(r["app_id"], r["concurrent_in_game"]) for r in shop.table("fact_concurrent_players").collect()] == [(1, 7)]
    assert [(r["app_id"], r["review_count"], float(r["avg_playtime_at_review"])) for r in shop.table("fact_review_playtime_daily").collect()] == [(1, 151, 30.0)]
    overview = spark.read.parquet(str(tmp_path / "wh/mart_game_overview")).collect()
    assert [(r["name"], r["genres"], r["final_price"]) for r in overview] == [("A", "RPG", 1450)]
    tracked = {r["appid"]: r for r in shop.table("tracked_games").collect()}
    assert tracked[1]["review_cursors"] == {"english": "c2"} and tracked[1]["reviews_collected_at"] is not None and tracked[2]["review_cursors"] == {}
    put(*page(1, "english", "c2"), {"success": 1, "reviews": [review(500)], "cursor": "c3"})
    put(*page(1, "english", "c3"), {"success": 1, "reviews": []})
    assert shop.crawl(DAY, api, clock="0100", **options).colour == "green" and shop.run(DAY).colour == "green"
    assert {r["review_count"] for r in shop.table("fact_review_daily").collect()} == {152}


def test_failed_games_are_reported(spark, tmp_path):
    """Games that can't be fetched are named, the others arrive; if all fail, so does the step."""
    folder = tmp_path / "answers"
    folder.mkdir()
    recorded(folder)
    tracked = lambda *ids: spark.createDataFrame([(i, DAY, DAY, True, True, True, None, {}) for i in ids], S.TRACKED_GAMES)
    options, out = {"fixtures": str(folder), "languages": "english,korean", "workers": "3"}, str(tmp_path / "bronze")
    assert bronze.crawl_players(spark, tracked(1, 2, 3), out, DAY, **options).keys() == {3}
    assert [r["appid"] for r in read_bronze_json(spark, f"{out}/player_counts/", S.PLAYER_COUNTS).collect()] == [1]
    assert bronze.crawl_details(spark, tracked(1, 2, 3), out, DAY, **options).keys() == {3}
    after, skipped = bronze.crawl_reviews(spark, tracked(1, 2, 3), out, DAY, **options)
    assert skipped.keys() == {3} and "no recorded answer" in skipped[3]
    assert {r["appid"]: r["review_cursors"] for r in after.collect()} == {1: {"english": "c2"}, 2: {}, 3: {}}
    assert spark.read.parquet(f"{out}/reviews/{DAY:%Y%m%d}/reviews.parquet").where("appid = 1").count() == 152
    with pytest.raises(StoreError):
        bronze.crawl_players(spark, tracked(3, 4), out, DAY, **options)
    shop = Storefront(spark, out, str(tmp_path / "wh"))
    shop.save("tracked_games", tracked(1, 3))
    report = shop.crawl(DAY, StoreApi(replay_transport(str(folder)), lambda s: None), **options)
    assert report.colour == "yellow" and not report.failed and {k: set(v) for k, v in report.skipped.items()} == dict.fromkeys(("players", "details", "reviews"), {3})


def test_only_touched_partitions_change(spark, tmp_path):
    """A review that changes its language or month moves, the partition that it leaves is gone, and other partitions keep their files."""
    out, wh = tmp_path / "bronze", tmp_path / "wh"
    author = ("s", 60, 30, 0, 1, 1)
    one = lambda i, app, lang, at=1744185600, upd=1: (str(i), author, lang, "Great story", at, upd, True, 1, 0, "0.5", True, False, False, app)
    put = lambda day, *rows: spark.createDataFrame(list(rows), S.REVIEWS).write.parquet(str(out / "reviews" / day / "a.parquet"))
    put("20250409", one(1, 1, "koreana"), one(2, 1, "english"), one(3, 2, "english"), one(4, 1, None), one(5, 1, ""), one(6, 1, "a/b"), one(7, 3, "english"), one(8, None, "english"))
    put("20250410", one(1, 1, "english", upd=2), one(9, 1, None), one(6, 1, "english", upd=2), one(7, 3, "english", at=1746777600, upd=2), one(3, 1, "english"))
    shop = Storefront(spark, str(out), str(wh))
    shop.load_reviews(DAY)
    files = lambda app: {p.name for p in (wh / "reviews" / f"appid={app}").rglob("*.parquet")}
    left = files(2)
    shop.load_reviews(date(2025, 4, 10))
    rows = {(r["appid"], r["recommendationid"], r["language"], r["month"]) for r in spark.read.parquet(str(wh / "reviews")).collect()}
    assert rows == {(1, "1", "english", 4), (1, "2", "english", 4), (2, "3", "english", 4), (1, "3", "english", 4), (1, "4", None, 4), (1, "5", None, 4), (1, "6", "english", 4), (3, "7", "english", 5), (1, "9", None, 4)}
    assert files(2) == left and spark.read.parquet(str(wh / "reviews_quarantine")).count() == 1
    assert {p.relative_to(wh / "reviews").parts[1] for p in (wh / "reviews/appid=1").rglob("*.parquet")} == {"language=__HIVE_DEFAULT_PARTITION__", "language=english"}
    assert not list((wh / "reviews/appid=3").rglob("month=04"))


def test_text_object(spark, tmp_path):
    for text in ("first ü", "second"):
        write_text(spark, text, f"{tmp_path}/a/hello.txt")
        assert (tmp_path / "a/hello.txt").read_text() == text


def test_no_default_limit(tmp_path):
    recorded(tmp_path)
    rows, after = StoreApi(replay_transport(str(tmp_path)), lambda s: None).reviews(1, {}, ["english"])
    assert len(rows) == 151 and after == {"english": "c2"}


def test_requests(monkeypatch):
    hosts = {"api": "http://a/", "store": "http://s"}
    assert request_url(hosts, "reviews", {"appid": 7, "cursor": "*"}) == "http://s/appreviews/7?json=1&purchase_type=all&cursor=%2A"
    assert request_url(hosts, "app_list", {"key": "k", "include_dlc": False}) == "http://a/IStoreService/GetAppList/v1/?key=k&include_dlc=false"
    for error in (urllib.error.URLError("refused"), TimeoutError(), ValueError("no JSON")):
        def fail(*a, error=error, **k):
            raise error

        monkeypatch.setattr(urllib.request, "urlopen", fail)
        with pytest.raises(StoreError):
            http_transport("http://a", "http://s")("players", {"appid": 1})


def test_crawl_targets(spark):
    rows = [(1, date(2025, 1, 1), True, True), (2, date(2025, 1, 3), True, True), (3, date(2025, 1, 2), False, True), (4, None, True, False), (5, None, True, True)]
    df = spark.createDataFrame(rows, "appid int, last_discounted date, is_active boolean, collect_reviews boolean")
    ids = lambda d: [r["appid"] for r in d.collect()]
    assert ids(bronze.crawl_targets(df, "collect_reviews")) == [5, 2, 1] and ids(bronze.crawl_targets(df, "collect_reviews", limit=2)) == [5, 2]
    assert ids(bronze.crawl_targets(df, newest_first=False)) == [1, 2, 4, 5]


def test_json_round_trip(spark, tmp_path):
    rows = [(1, 7, "t"), (2, None, "ü\n\"x"), (3, 9, None)]
    df = spark.createDataFrame(rows, S.PLAYER_COUNTS)
    path = f"{tmp_path}/counts/a.json"
    for _ in range(2):
        write_json(df, path)
        assert {tuple(r)[:3] for r in read_bronze_json(spark, f"{tmp_path}/counts/", S.PLAYER_COUNTS).collect()} == set(rows)


@pytest.mark.parametrize("step", ["writing", "written", "aside", "moved"])
def test_swap_cut_off(spark, tmp_path, step):
    """A writer that dies at any step loses no row; the next one goes on."""
    path = tmp_path / "t"
    old, new = spark.range(5), spark.range(100, 109)
    swap_in(old, str(path))
    if step != "writing":
        new.write.parquet(f"{path}__next")
    else:
        new.write.parquet(f"{path}__next")
        (tmp_path / "t__next/_SUCCESS").unlink()
    if step in ("aside", "moved"):
        path.rename(tmp_path / "t__prev")
    if step == "moved":
        (tmp_path / "t__next").rename(path)
    recover(spark, str(path))
    want = {r[0] for r in (old if step in ("writing", "written") else new).collect()}
    assert {r[0] for r in spark.read.parquet(str(path)).collect()} == want
    swap_in(spark.read.parquet(str(path)).unionByName(spark.range(1000, 1001)), str(path))
    assert {r[0] for r in spark.read.parquet(str(path)).collect()} == want | {1000}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_last_place_wins(spark):
    item = lambda cents: {"appid": 1, "best_purchase_option": {"final_price_in_cents": cents}}
    feed = spark.createDataFrame([(json.dumps({"ids": [], "store_items": [item("900"), item("100")]}),)], "j string").select(F.from_json("j", S.DISCOUNT_GAMES.replace("response ", "", 1)).alias("response"))
    fact = silver.merge_prices(spark.createDataFrame([], S.FACT_PRICE), silver.price_rows(feed, DAY))
    assert [r["final_price"] for r in fact.collect()] == [100]
    at = "2025-04-09T08:00:00+00:00"
    counts = spark.createDataFrame([(1, 900, at), (1, 100, at)], S.PLAYER_COUNTS).coalesce(1)
    assert [r["concurrent_in_game"] for r in silver.merge_players(spark.createDataFrame([], S.FACT_PLAYERS), counts).collect()] == [100]
