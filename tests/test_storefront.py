"""Hand-computed cases of FIXTURES.md section D, properties of the operators, and one run of the whole pipeline."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrine import schemas as S
from vitrine.functions import english_tokens, noun_tokens, release_date, safe_int
from vitrine.operators import baseline_avg, insert_only, upsert
from vitrine.plans import gold, marts, silver, staging
from vitrine.plans.pipeline import Storefront
from vitrine.sources.store_feed import StoreApi, StoreError, StoreFeedSource, replay_transport, request_key
from vitrine.session import ship
from vitrine.streaming.reviews import daily_counts_stream, drain_reviews, last_cursors

T = datetime(2025, 4, 9, 8)


def make(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def games(spark):
    return make(spark, [(730, "A"), (570, "B")], "app_id int, name string")


def players(spark):
    rows = [(730, 100, "2025-04-09T08:00:00+00:00"), (730, 201, "2025-04-09T14:00:00+00:00"), (730, 90, "2025-04-10T08:00:00+00:00"), (570, None, "2025-04-09T08:00:00+00:00")]
    fact = silver.merge_players(make(spark, [], S.FACT_PLAYERS), make(spark, rows, S.PLAYER_COUNTS))
    return staging.stg_concurrent_players(fact)


def prices(spark, rows):
    return make(spark, rows, "app_id int, discount_percent int, initial_price int, final_price int, discount_end_at timestamp, collected_at date")


def test_d1_daily_players(spark):
    got = {(r["app_id"], str(r["snapshot_date"])): tuple(r)[2:] for r in marts.mart_player_daily_avg(players(spark)).collect()}
    assert got == {(730, "2025-04-09"): (151.0, 201, 100, 2), (730, "2025-04-10"): (90.0, 90, 90, 1)}


def test_d2_player_trend(spark, games):
    rows = {str(r["date"]): r for r in marts.mart_discount_player_trend(players(spark), prices(spark, [(730, 50, 200, 100, None, date(2025, 4, 10))]), games).collect()}
    a, b = rows["2025-04-09"], rows["2025-04-10"]
    assert (a["is_discounted"], a["discount_percent"], a["final_price"], a["baseline_7d_avg"]) == (False, 0, None, None)
    assert (b["is_discounted"], b["discount_percent"], b["baseline_7d_avg"], b["game_name"]) == (True, 50, 151.0, "A")


def test_d3_baseline_counts_rows(spark):
    days = [date(2025, 1, i) for i in range(1, 5)] + [date(2025, 2, i) for i in range(3, 8)]
    df = make(spark, [(1, d, float(i)) for i, d in enumerate(days, 1)], "a int, d date, v double")
    got = [r["b"] for r in df.withColumn("b", baseline_avg("v", "a", "d")).orderBy("d").collect()]
    assert got[0] is None and got[8] == 5.0


def test_d4_weighted_playtime(spark, games):
    fact = make(spark, [(730, "korean", date(2025, 4, 9), Decimal("30.00"), Decimal("1"), 2, T), (730, "english", date(2025, 4, 9), None, Decimal("1"), 1, T)], S.FACT_PLAYTIME_DAILY)
    r = marts.mart_discount_playtime_trend(fact, prices(spark, []), games).first()
    assert float(r["avg_playtime_at_review_min"]) == 20.0 and float(r["avg_playtime_at_review_hr"]) == 0.33 and r["total_review_count"] == 3


def test_d5_d6_tokens(spark):
    at = [datetime(2025, 1, d) for d in (1, 2, 3)]
    lake = make(spark, list(zip([1] * 3, ["english"] * 3, ["Great great story!", "The story isn't great", "gg"], at)), "appid int, language string, review string, timestamp_created timestamp")
    rows = {r["morpheme"]: r for r in gold.english_review_tokens(lake).collect()}
    assert {k: (r["frequency"], r["review_appearances"]) for k, r in rows.items()} == {"great": (3, 2), "story": (2, 2), "isn": (1, 1)}
    assert {(r["earliest_review_at"], r["latest_review_at"]) for r in rows.values()} == {(at[0], at[1])}
    assert [r["morpheme"] for r in gold.english_review_tokens(lake, 1).collect()] == ["great"]


def test_d7_d8_overview_and_analysis(spark):
    g = make(spark, [(1, "A"), (2, "B")], "app_id int, name string").withColumns({c: F.lit(None).cast("string") for c in "type is_free developers publishers release_date platforms_windows platforms_mac platforms_linux total_recommendations".split()})
    p = prices(spark, [(1, 10, 5, 4, None, date(2025, 1, 1)), (1, 0, 5, 5, None, date(2025, 1, 5)), (1, 30, 5, 3, None, date(2025, 1, 3))])
    pairs, names = make(spark, [(1, 1), (1, 2), (1, 3)], S.DIM_GAME_GENRES), make(spark, [(1, "Indie"), (2, "RPG"), (3, "Action")], S.DIM_GENRES)
    rows = {r["app_id"]: r for r in marts.mart_game_overview(g, p, pairs, names).collect()}
    assert (rows[1]["genres"], rows[2]["genres"], str(rows[1]["price_collected_at"]), rows[2]["final_price"]) == ("Action, Indie, RPG", None, "2025-01-05", None)
    a = marts.mart_discount_analysis(p, g).collect()
    assert [(r["discount_count"], r["avg_discount_pct"], r["max_discount_pct"], str(r["first_seen_discount"]), str(r["last_seen_discount"])) for r in a] == [(2, 20.0, 30, "2025-01-01", "2025-01-03")]


def test_d9_d10_parsing(spark):
    df = make(spark, [(x,) for x in ("Jul 9, 2013", "9 Jul, 2013", "2013-7-9", "TBA", "", "July 9, 2013")], "t string")
    assert [str(r[0]) for r in df.select(release_date(F.col("t"))).collect()] == ["2013-07-09"] * 3 + ["None"] * 3
    df = make(spark, [("2900",), (" 29 ",), ("29.5",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(safe_int(F.col("t"))).collect()] == [2900, 29, None, None, None]


def test_d11_price_upsert_overwrites_with_null(spark):
    row = lambda end: (730, "KRW", 2, 1, 50, False, end, date(2025, 4, 9))
    fact = silver.merge_prices(make(spark, [row(T)], S.FACT_PRICE), make(spark, [row(None)], S.FACT_PRICE))
    assert [r["discount_end_at"] for r in fact.collect()] == [None]


def test_d12_tracked_games(spark):
    old = make(spark, [(730, date(2025, 4, 1), date(2025, 4, 1), False, True, True, None, {"korean": "x"})], S.TRACKED_GAMES)
    rows = {r["appid"]: r for r in silver.merge_tracked(old, make(spark, [(730,), (10,)], "appid int"), date(2025, 4, 9)).collect()}
    assert (str(rows[730]["first_seen"]), str(rows[730]["last_discounted"]), rows[730]["is_active"], rows[730]["review_cursors"]) == ("2025-04-01", "2025-04-09", False, {"korean": "x"})
    assert (rows[10]["is_active"], rows[10]["collect_players"], rows[10]["review_cursors"], rows[10]["reviews_collected_at"]) == (True, True, {}, None)
    cursors = make(spark, [(730, "korean", "y"), (730, "english", "z"), (99, "korean", "q")], "appid int, language string, cursor string")
    after = silver.merge_cursors(old, cursors).collect()
    assert len(after) == 1 and after[0]["review_cursors"] == {"korean": "y", "english": "z"} and after[0]["reviews_collected_at"] is not None


def test_d15_details(spark):
    raw = {"name": "N", "genres": [{"id": "1", "description": "Indie"}, {"id": "x", "description": "no"}, {"description": "none"}], "developers": ["a", "b"], "required_age": "18"}
    df = make(spark, [(1, json.dumps(raw), "now"), (2, None, "now")], "appid int, detail string, collected_at string")
    r = silver.flatten_details(df).collect()
    assert len(r) == 1 and [g["genre_id"] for g in r[0]["genres"]] == [1] and (r[0]["developers"], r[0]["publishers"], r[0]["required_age"], r[0]["is_free"]) == ("a, b", "", 18, False)


def test_korean_nouns(spark):
    df = make(spark, [("게임 정말 재미",), (None,)], "t string")
    fake = noun_tokens(lambda: lambda t: [(w, "NNG" if len(w) != 3 else "VV") for w in t.split()])
    assert [r[0] for r in df.select(fake("t")).collect()] == [["게임", "정말", "재미"], []]
    assert [r[0] for r in df.select(noun_tokens(lambda: None)("t")).collect()] == [[], []]


KEYED = st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 9)), st.integers(0, 99)), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=KEYED, new=KEYED)
def test_upsert_properties(spark, old, new):
    kinds = "k int, v int, o int"
    target = make(spark, list({r[0]: r for r in old}.values()), kinds)
    source = make(spark, new, kinds)
    once = upsert(target, source, ["k"], ["v"], order=["o", "v"])
    last = {}
    for r in sorted(new, key=lambda r: (r[2], r[1] is not None, r[1] or 0)):
        last[r[0]] = r
    want = {r[0]: (r[1], r[2]) for r in old} | {k: (r[1], {x[0]: x for x in old}[k][2] if k in {x[0] for x in old} else r[2]) for k, r in last.items()}
    got = {r["k"]: (r["v"], r["o"]) for r in once.collect()}
    assert got == want and once.count() == len(want)
    assert {tuple(r) for r in upsert(once, source, ["k"], ["v"], order=["o", "v"]).collect()} == {tuple(r) for r in once.collect()}
    assert insert_only(target, source, ["k"]).count() == len(want)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(text=st.text(alphabet="aBc İthe games!\n", max_size=40))
def test_english_tokens(spark, text):
    got = make(spark, [(text,)], "t string").select(english_tokens(F.col("t"))).first()[0]
    assert all(3 <= len(w) <= 100 and w == w.lower() and w not in ("the", "games") for w in got)


# ---- feeds


@pytest.fixture
def recorded(tmp_path):
    def put(endpoint, params, answer):
        (tmp_path / request_key(endpoint, params)).write_text(json.dumps(answer))

    put("players", {"appid": 1}, {"response": {"result": 1, "player_count": 7}})
    put("players", {"appid": 2}, {"response": {"result": 42}})
    put("details", {"appids": 1, "cc": "kr", "l": "korean"}, {"1": {"success": True, "data": {"name": "N"}}})
    review = lambda i: {"recommendationid": str(i), "review": "good"}
    for language in ("korean", "english"):
        for cursor, ids, after in (("*", (1, 2), "c1"), ("c1", (2, 3), "c2"), ("c2", (), "c2")):
            put("reviews", {"appid": 1, "language": language, "cursor": cursor, "filter": "recent", "num_per_page": 100}, {"success": 1, "reviews": [review(i) for i in ids], "cursor": after})
    put("app_list", {"key": "", "max_results": 2, "last_appid": 0, "include_games": True, "include_dlc": False, "include_software": False}, {"response": {"apps": [{"appid": 1}, {"appid": 2}], "have_more_results": True, "last_appid": 2}})
    put("app_list", {"key": "", "max_results": 2, "last_appid": 2, "include_games": True, "include_dlc": False, "include_software": False}, {"response": {"apps": [{"appid": 3}]}})
    return str(tmp_path)


def test_store_api(recorded):
    waits = []
    api = StoreApi(replay_transport(recorded), waits.append)
    assert [a["appid"] for a in api.app_list(2)] == [1, 2, 3] and len(waits) == 1
    assert (api.current_players(1), api.current_players(2), api.app_details(1)) == (7, None, {"name": "N"})
    rows, after = api.reviews(1, {}, ["korean"], limit=None)
    assert [r["recommendationid"] for r in rows] == ["1", "2", "3"] and after == {"korean": "c2"}
    with pytest.raises(StoreError):
        api.current_players(9)


def test_store_feed(spark, recorded, tmp_path):
    ship(spark)
    spark.dataSource.register(StoreFeedSource)
    read = lambda **o: spark.read.format("store_feed").options(fixtures=recorded, **o).load()
    assert {(r["appid"], r["player_count"]) for r in read(feed="players", app_ids="1,2,9", workers="1", now="n").collect()} == {(1, 7), (2, None)}
    assert read(feed="reviews", app_ids="1", languages="korean").count() == 4
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    options = {"fixtures": recorded, "app_ids": "1", "languages": "korean,english"}
    drain_reviews(spark, options, out, state)
    assert spark.read.parquet(out).count() == 8 and last_cursors(state) == {"1/korean": "c2", "1/english": "c2"}
    drain_reviews(spark, options, out, state)
    assert spark.read.parquet(out).count() == 8


def test_daily_stream(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    schema = spark.read.parquet(src).schema
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "events.parquet").symlink_to(src)
    events = spark.readStream.schema(schema).parquet(str(folder)).withColumn("ts", F.col("ts").cast("timestamp"))
    q = daily_counts_stream(events, "user_id", "ts").writeStream.format("memory").queryName("daily").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    want = spark.read.parquet(src).groupBy("user_id", F.to_date("ts").alias("review_date")).count()
    assert {tuple(r) for r in spark.table("daily").collect()} == {tuple(r) for r in want.collect()}


# ---- the whole run


def test_pipeline(spark, tmp_path):
    bronze, run = tmp_path / "bronze", "20250409"
    for d in ("discount_games", "player_counts"):
        (bronze / d).mkdir(parents=True)
    item = lambda app, cents: {"appid": app, "name": "x", "best_purchase_option": {"original_price_in_cents": "2900", "final_price_in_cents": cents, "discount_pct": 50, "active_discounts": [{"discount_end_date": 1735689600}]}}
    for hour, cents in (("0800", "1"), ("1400", "1450")):
        (bronze / "discount_games" / f"{run}{hour}.json").write_text(json.dumps({"response": {"ids": [{"appid": 1}], "store_items": [item(1, cents), item(None, "2")]}}, indent=2))
    (bronze / "player_counts" / f"{run}.json").write_text(json.dumps([{"appid": 1, "player_count": 10, "collected_at": "2025-04-09T08:00:00+00:00"}, {"appid": 1, "player_count": None, "collected_at": "2025-04-09T14:00:00+00:00"}], indent=2))
    raw = make(spark, [(1, json.dumps({"name": "Game", "genres": [{"id": "2", "description": "RPG"}], "release_date": {"date": "Jul 9, 2013"}}), "c")], "appid int, detail string, collected_at string")
    silver.flatten_details(raw).write.parquet(str(bronze / "appdetails" / run / "a.parquet"))
    kinds = S.REVIEWS
    author = ("s", 60, 30, 0, 1, 1)
    one = lambda i, at, upd, text="Great story", lang="english": (str(i), author, lang, text, at, upd, True, 1, 0, "0.5", True, False, False, 1)
    first = make(spark, [one(1, 1744185600, 1), one(1, 1744185600, 2, "Great ending"), one(2, None, 1), one(3, 1744185600, 1, "재미", "koreana")], kinds)
    first.write.parquet(str(bronze / "reviews" / run / "b.parquet"))
    make(spark, [one(4, 1744185600, 1)], kinds).drop("votes_funny").write.parquet(str(bronze / "reviews" / f"{run}b" / "c.parquet"))
    shop = Storefront(spark, str(bronze), str(tmp_path / "wh"), lambda: lambda t: [(w, "NNG") for w in t.split()])
    for _ in range(2):  # a second run changes nothing
        report = shop.run(date(2025, 4, 9))
        assert report.colour == "green", report
        tables = {t: spark.read.parquet(str(tmp_path / "wh" / t)).collect() for t in ("fact_price_history", "dim_games", "fact_review_daily", "gold_review_morphemes", "mart_game_overview", "mart_discount_review_trend", "reviews")}
        assert [(r["final_price"], str(r["discount_end_at"])) for r in tables["fact_price_history"]] == [(1450, "2025-01-01 00:00:00")]
        assert {(r["language"], r["review_count"]) for r in tables["fact_review_daily"]} == {("english", 2), ("korean", 1)}
        assert {(r["morpheme"], r["frequency"]) for r in tables["gold_review_morphemes"]} == {("great", 2), ("ending", 1), ("story", 1), ("재미", 1)}
        assert [(r["genres"], str(r["release_date"])) for r in tables["mart_game_overview"]] == [("RPG", "2013-07-09")]
        assert [(r["total_review_count"], r["korean_review_count"], r["ab_group"]) for r in tables["mart_discount_review_trend"]] == [(3, 1, "discount")]
        assert {(r["recommendationid"], r["votes_funny"]) for r in tables["reviews"]} == {("1", 0), ("3", 0), ("4", None)}
    assert (tmp_path / "wh/reviews/appid=1/language=english/year=2025/month=04").is_dir()


def test_failed_steps_are_reported(spark, tmp_path):
    report = Storefront(spark, str(tmp_path / "no"), str(tmp_path / "wh")).run(date(2025, 4, 9))
    assert report.colour == "yellow" and {"prices", "details", "players", "reviews"} <= report.failed.keys()
