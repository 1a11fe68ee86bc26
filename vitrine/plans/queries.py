"""The engine's operators applied to the driver's tables, each with the same question in DuckDB SQL where SQL can ask it.

Stand-ins: ``events`` is a time series of games (user_id) with snapshots (ts, value) and review languages
(event_type); ``lineitem`` and ``part`` are prices; ``documents`` are review texts.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import ENGLISH_STOPWORDS, english_tokens, epoch_to_timestamp, first_or_null, joined_names, normalize_language, release_date, safe_int
from ..operators import active_semi_join, baseline_avg, conditional_sums, insert_only, keyed_update, latest_per_key, ordered_string_agg, replace_groups, top_n_per_group, union_by_name, upsert, weighted_mean
from ..schemas import REVIEWS
from ..session import scratch_root
from . import bronze, gold, marts, silver
from .pipeline import Storefront

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- daily aggregates


def _players(spark, d):
    return table(spark, d, "events").select(F.col("user_id").alias("app_id"), F.to_date("ts").alias("snapshot_date"), F.col("value").alias("concurrent_in_game"), "event_id")


@query("""select user_id app_id, cast(ts as date) snapshot_date, round(avg(value)) avg_concurrent, max(value) max_concurrent,
    min(value) min_concurrent, count(*) snapshot_count from events group by 1, 2""")
def player_daily_avg(spark, d):
    return marts.mart_player_daily_avg(_players(spark, d), "event_id")


@query("""select user_id app_id, event_type "language", cast(ts as date) review_date, cast(count(*) as bigint) review_count
    from events group by 1, 2, 3""")
def review_daily_count(spark, d):
    lake = table(spark, d, "events").select(F.col("user_id").alias("appid"), F.col("event_type").alias("language"), F.col("ts").alias("timestamp_created"))
    return silver.review_daily(lake).select(F.col("app_id"), "language", "review_date", F.col("review_count").cast("long").alias("review_count"))


CENTS_SQL = """select user_id app_id, event_type "language", cast(ts as date) review_date,
    cast((2*sum(cast(round(value*100) as bigint)) + count(*)) // (2*count(*)) as bigint) avg_cents, cast(count(*) as bigint) review_count
    from events group by 1, 2, 3"""


@query(CENTS_SQL)
def review_playtime_daily(spark, d):
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    mean = F.expr("(2*cents + review_count) div (2*review_count)").alias("avg_cents")
    daily = table(spark, d, "events").groupBy(F.col("user_id").alias("app_id"), F.col("event_type").alias("language"), F.to_date("ts").alias("review_date")).agg(cents.alias("cents"), F.count("*").alias("review_count"))
    return daily.select("app_id", "language", "review_date", mean, "review_count")


@query("""select l_partkey app_id, p_name "name", count(*) discount_count, round(avg(cast(round(l_discount*100) as int))) avg_discount_pct,
    max(cast(round(l_discount*100) as int)) max_discount_pct, min(l_extendedprice) lowest_price, max(l_extendedprice) original_price,
    min(cast(l_shipdate as date)) first_seen_discount, max(cast(l_shipdate as date)) last_seen_discount
    from lineitem left join part on l_partkey = p_partkey where l_discount > 0 group by 1, 2""")
def discount_analysis(spark, d):
    prices = table(spark, d, "lineitem").where("l_discount > 0").select(
        F.col("l_partkey").alias("app_id"), F.round(F.col("l_discount") * 100).cast("int").alias("discount_percent"),
        F.col("l_extendedprice").alias("final_price"), F.col("l_extendedprice").alias("initial_price"), F.to_date("l_shipdate").alias("collected_at"),
    )
    games = table(spark, d, "part").select(F.col("p_partkey").alias("app_id"), F.col("p_name").alias("name"))
    return marts.mart_discount_analysis(prices, games)


# ---- trends with the day's price and a trailing baseline

PRICE_SQL = """p as (select app_id, price_date, greatest(dp, 0) discount_percent, dp > 0 is_discounted from (
    select user_id app_id, cast(ts as date) price_date, cast(floor(value/10) as int) - 20 dp,
    row_number() over (partition by user_id, cast(ts as date) order by ts desc, event_id desc) rn
    from events where event_type = 'purchase') where rn = 1),
  g as (select c_custkey, c_name game_name from customer)"""


def _prices(spark, d):
    bought = table(spark, d, "events").where("event_type = 'purchase'").withColumn("collected_at", F.to_date("ts"))
    last = latest_per_key(bought, ["user_id", "collected_at"], ["ts", "event_id"])
    off = F.floor(F.col("value") / 10).cast("int") - 20
    return last.select(F.col("user_id").alias("app_id"), "collected_at", F.greatest(off, F.lit(0)).alias("discount_percent"))


def _games(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("app_id"), F.col("c_name").alias("name"))


@query(f"""with {PRICE_SQL}, r as (select user_id app_id, cast(ts as date) "date", cast(count(*) as bigint) total_review_count,
    cast(sum(case when event_type = 'view' then 1 else 0 end) as bigint) korean_review_count,
    cast(sum(case when event_type = 'click' then 1 else 0 end) as bigint) english_review_count from events group by 1, 2)
  select r.app_id, game_name, "date", total_review_count, korean_review_count, english_review_count,
    coalesce(is_discounted, false) is_discounted, coalesce(discount_percent, 0) discount_percent,
    case when coalesce(is_discounted, false) then 'discount' else 'normal' end ab_group,
    round(avg(total_review_count) over (partition by r.app_id order by "date" rows between 7 preceding and 1 preceding), 6) baseline_7d_avg
  from r left join p on r.app_id = p.app_id and "date" = price_date left join g on r.app_id = c_custkey""")
def discount_review_trend(spark, d):
    label = F.when(F.col("event_type") == "view", "korean").when(F.col("event_type") == "click", "english").otherwise(F.col("event_type"))
    daily = table(spark, d, "events").groupBy(F.col("user_id").alias("app_id"), label.alias("language"), F.to_date("ts").alias("review_date")).agg(F.count("*").alias("review_count"))
    prices = _prices(spark, d).withColumns({"initial_price": F.lit(None).cast("int"), "final_price": F.lit(None).cast("int"), "discount_end_at": F.lit(None).cast("timestamp")})
    out = marts.mart_discount_review_trend(daily, prices, _games(spark, d))
    return out.drop("initial_price", "final_price", "discount_end_at").withColumn("baseline_7d_avg", F.round("baseline_7d_avg", 6))


@query(f"""with {PRICE_SQL}, r as (select user_id app_id, cast(ts as date) "date", round(avg(value)) avg_concurrent, max(value) max_concurrent
    from events group by 1, 2)
  select r.app_id, game_name, "date", avg_concurrent, max_concurrent, coalesce(discount_percent, 0) discount_percent,
    coalesce(is_discounted, false) is_discounted,
    round(avg(avg_concurrent) over (partition by r.app_id order by "date" rows between 7 preceding and 1 preceding), 6) baseline_7d_avg
  from r left join p on r.app_id = p.app_id and "date" = price_date left join g on r.app_id = c_custkey""")
def discount_player_trend(spark, d):
    prices = _prices(spark, d).withColumns({"initial_price": F.lit(None).cast("int"), "final_price": F.lit(None).cast("int"), "discount_end_at": F.lit(None).cast("timestamp")})
    out = marts.mart_discount_player_trend(_players(spark, d), prices, _games(spark, d), "event_id")
    return out.drop("initial_price", "final_price", "discount_end_at").withColumn("baseline_7d_avg", F.round("baseline_7d_avg", 6))


@query(f"""with {PRICE_SQL}, dl as ({CENTS_SQL}), r as (select app_id, review_date "date", cast(sum(review_count) as bigint) total_review_count,
    cast((2*sum(review_count*avg_cents) + sum(review_count)) // (2*sum(review_count)) as bigint) cents from dl group by 1, 2)
  select r.app_id, game_name, "date", cents / 100.0 avg_playtime_at_review_min, cast((2*cents + 60) // 120 as bigint) / 100.0 avg_playtime_at_review_hr,
    total_review_count, coalesce(is_discounted, false) is_discounted, coalesce(discount_percent, 0) discount_percent,
    case when coalesce(is_discounted, false) then 'discount' else 'normal' end ab_group,
    round(avg(cents) over (partition by r.app_id order by "date" rows between 7 preceding and 1 preceding), 6) baseline_7d_cents
  from r left join p on r.app_id = p.app_id and "date" = price_date left join g on r.app_id = c_custkey""")
def discount_playtime_trend(spark, d):
    """The playtime mart's shape in integer cents, which both engines round alike."""
    weighted = review_playtime_daily(spark, d).groupBy("app_id", F.col("review_date").alias("date")).agg(F.sum(F.col("review_count") * F.col("avg_cents")).alias("s"), F.sum("review_count").alias("total_review_count"))
    daily = weighted.withColumn("cents", F.expr("(2*s + total_review_count) div (2*total_review_count)"))
    daily = daily.withColumn("baseline_7d_cents", F.round(baseline_avg("cents", "app_id", "date"), 6))
    return marts._with_prices(daily, "date", _prices(spark, d), _games(spark, d)).select(
        "app_id", "game_name", "date", (F.col("cents") / 100.0).alias("avg_playtime_at_review_min"), (F.expr("(2*cents + 60) div 120") / 100.0).alias("avg_playtime_at_review_hr"),
        "total_review_count", marts._discounted().alias("is_discounted"), marts._percent().alias("discount_percent"), marts._ab_group().alias("ab_group"), "baseline_7d_cents",
    )


@query(f"""with {PRICE_SQL}, r as (select user_id app_id, cast(ts as date) review_date, cast(count(*) as bigint) review_count from events
    group by user_id, event_type, cast(ts as date))
  select r.app_id, review_date, review_count, is_discounted, discount_percent from r left join p on r.app_id = p.app_id and review_date = price_date""")
def reviews_with_price(spark, d):
    return marts.reviews_with_price(review_daily_count(spark, d), _prices(spark, d))


@query("""select user_id app_id, cast(ts as date) "date", round(avg(value) over (partition by user_id order by ts, event_id
    rows between 7 preceding and 1 preceding), 6) baseline from events""")
def trailing_baseline(spark, d):
    return table(spark, d, "events").select(F.col("user_id").alias("app_id"), F.to_date("ts").alias("date"), F.round(baseline_avg("value", "user_id", ["ts", "event_id"]), 6).alias("baseline"))


@query("""select cast(ts as date) review_date, cast(sum(case when event_type='view' then 1 else 0 end) as bigint) views,
    cast(sum(case when event_type='purchase' then 1 else 0 end) as bigint) purchases from events group by 1""")
def conditional_counts(spark, d):
    daily = table(spark, d, "events").withColumn("one", F.lit(1)).groupBy(F.to_date("ts").alias("review_date"))
    return daily.agg(*conditional_sums("one", "event_type", {"view": "views", "purchase": "purchases"}))


@query("""select l_partkey, cast(sum(cast(l_quantity as bigint) * cast(round(l_discount*100) as bigint)) as double)
    / nullif(cast(sum(cast(l_quantity as bigint)) as double), 0) mean_discount from lineitem group by 1""")
def weighted_mean_discount(spark, d):
    whole = table(spark, d, "lineitem").select("l_partkey", F.col("l_quantity").cast("long").cast("double").alias("q"), F.round(F.col("l_discount") * 100).alias("off"))
    return whole.groupBy("l_partkey").agg(weighted_mean("off", "q").alias("mean_discount"))


# ---- latest rows, ordered strings, overview

PRICE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
LATEST_SQL = """select distinct on (l_partkey) l_partkey app_id, l_extendedprice final_price, l_discount discount, cast(l_shipdate as date) price_collected_at
    from lineitem order by l_partkey, l_shipdate desc, l_orderkey desc, l_linenumber desc, l_suppkey desc, l_extendedprice desc"""


@query(LATEST_SQL)
def latest_price(spark, d):
    return latest_per_key(table(spark, d, "lineitem"), ["l_partkey"], PRICE_ORDER).select(F.col("l_partkey").alias("app_id"), F.col("l_extendedprice").alias("final_price"), F.col("l_discount").alias("discount"), F.to_date("l_shipdate").alias("price_collected_at"))


GENRE_SQL = """select s_nationkey nation, string_agg(n_name, ', ' order by n_name) genres from
    (select distinct s_nationkey, n.n_name from supplier join nation m on s_nationkey = m.n_nationkey join nation n on m.n_regionkey = n.n_regionkey) group by 1"""


@query(GENRE_SQL)
def genre_string_agg(spark, d):
    nation = table(spark, d, "nation")
    own = nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    pairs = table(spark, d, "supplier").select("s_nationkey").distinct().join(own, "s_nationkey").join(nation.select("n_regionkey", "n_name"), "n_regionkey").distinct()
    return ordered_string_agg(pairs.withColumnRenamed("s_nationkey", "nation"), ["nation"], "n_name", "genres")


@query(f"""with lp as ({LATEST_SQL}), ga as (select l_partkey app_id, string_agg(m, ', ' order by m) genres from
    (select distinct l_partkey, l_returnflag || l_linestatus m from lineitem) group by 1)
  select p_partkey app_id, p_name "name", p_type "type", genres, final_price, price_collected_at from part
  left join ga on ga.app_id = p_partkey left join lp on lp.app_id = p_partkey""")
def game_overview(spark, d):
    rest = "is_free developers publishers release_date platforms_windows platforms_mac platforms_linux total_recommendations".split()
    games = table(spark, d, "part").select(F.col("p_partkey").alias("app_id"), F.col("p_name").alias("name"), F.col("p_type").alias("type"), *[F.lit(None).cast("string").alias(c) for c in rest])
    marks = table(spark, d, "lineitem").select(F.col("l_partkey").alias("app_id"), F.concat("l_returnflag", "l_linestatus").alias("genre_name")).distinct()
    pairs, genres = marks.select("app_id", F.col("genre_name").alias("genre_id")), marks.select(F.col("genre_name").alias("genre_id"), "genre_name").distinct()
    # One price for each day: the mart takes the latest day.
    daily = latest_per_key(table(spark, d, "lineitem").withColumn("collected_at", F.to_date("l_shipdate")), ["l_partkey", "collected_at"], PRICE_ORDER)
    prices = daily.select(F.col("l_partkey").alias("app_id"), "collected_at", F.col("l_extendedprice").alias("final_price"), F.lit(None).cast("int").alias("initial_price"), F.lit(None).cast("int").alias("discount_percent"))
    return marts.mart_game_overview(games, prices, pairs, genres).select("app_id", "name", "type", "genres", "final_price", "price_collected_at")


@query("""select o_orderkey, o_orderdate from orders order by o_orderdate desc, o_orderkey limit 100""")
def top_n_limit(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(100)


@query("""select o_custkey, o_orderkey from (select o_custkey, o_orderkey, row_number() over (partition by o_custkey
    order by o_totalprice desc, o_orderkey) rn from orders) where rn <= 3""")
def top_n_per_customer(spark, d):
    return top_n_per_group(table(spark, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey")


# ---- joins and filters


@query("""select event_id, user_id from events where user_id in (select c_custkey from customer where c_mktsegment = 'BUILDING')""")
def active_semi(spark, d):
    control = table(spark, d, "customer").withColumn("is_active", F.col("c_mktsegment") == "BUILDING")
    return active_semi_join(table(spark, d, "events"), control, "user_id", "c_custkey", "is_active").select("event_id", "user_id")


@query("""select event_id, user_id from events where user_id in (select c_custkey from customer where c_acctbal > 0 and c_mktsegment <> 'BUILDING')""")
def active_two_flags(spark, d):
    control = table(spark, d, "customer").withColumns({"is_active": F.col("c_acctbal") > 0, "collect_players": F.col("c_mktsegment") != "BUILDING"})
    return active_semi_join(table(spark, d, "events"), control, "user_id", "c_custkey", "is_active", "collect_players").select("event_id", "user_id")


@query("""select event_id, user_id, event_type from events where user_id is not null and event_type is not null and value > 100""")
def filter_required(spark, d):
    return table(spark, d, "events").dropna(subset=["user_id", "event_type"]).where("value > 100").select("event_id", "user_id", "event_type")


@query("""select c_custkey, case when o.k is not null then o.n else c_nationkey end c_nationkey from customer
    left join (select o_custkey k, cast(count(*) as int) n from orders group by 1) o on k = c_custkey""")
def update_by_key(spark, d):
    counts = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").cast("int").alias("c_nationkey"))
    return keyed_update(table(spark, d, "customer").select("c_custkey", "c_nationkey"), counts, ["c_custkey"], ["c_nationkey"])


# ---- upserts

# Target and source are all users by day; a day without events of either kind gives known, new and untouched keys.
SLICES_SQL = """t as (select user_id k, cast(ts as date) d, cast(count(*) as bigint) n, max(value) v from events where event_type in ('click', 'view') group by 1, 2),
  u as (select user_id k, cast(ts as date) d, cast(count(*) as bigint) n, max(case when event_type = 'error' then value end) v from events where event_type in ('error', 'purchase') group by 1, 2)"""


def _slices(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("k"), F.to_date("ts").alias("d"), "event_type", "value")
    t = e.where("event_type in ('click', 'view')").groupBy("k", "d").agg(F.count("*").alias("n"), F.max("value").alias("v"))
    u = e.where("event_type in ('error', 'purchase')").groupBy("k", "d").agg(F.count("*").alias("n"), F.max(F.when(F.col("event_type") == "error", F.col("value"))).alias("v"))
    return t, u


@query(f"""with {SLICES_SQL} select coalesce(t.k, u.k) k, coalesce(t.d, u.d) d, case when u.k is not null then u.n else t.n end n,
    case when u.k is not null then u.v else t.v end v from t full join u on t.k = u.k and t.d = u.d""")
def upsert_replace(spark, d):
    t, u = _slices(spark, d)
    return upsert(t, u, ["k", "d"], ["n", "v"])


@query(f"""with {SLICES_SQL} select coalesce(t.k, u.k) k, coalesce(t.d, u.d) d, case when t.k is not null then t.n else u.n end n,
    case when u.k is not null then u.v else t.v end v from t full join u on t.k = u.k and t.d = u.d""")
def upsert_partial(spark, d):
    t, u = _slices(spark, d)
    return upsert(t, u, ["k", "d"], ["v"])


@query(f"""with {SLICES_SQL} select * from t union all select * from u where not exists (select 1 from t where t.k = u.k and t.d = u.d)""")
def upsert_insert_only(spark, d):
    return insert_only(*_slices(spark, d), ["k", "d"])


@query(f"""with {SLICES_SQL} select * from t where not exists (select 1 from u where t.k = u.k and t.d = u.d) union all select * from u""")
def replace_whole_groups(spark, d):
    return replace_groups(*_slices(spark, d), ["k", "d"])


# ---- set operations


@query("""select count(*) n_texts, cast(sum(keep) as bigint) sum_ids from (select text, min(doc_id) keep from documents group by 1)""")
def dedupe_totals(spark, d):
    return table(spark, d, "documents").groupBy("text").agg(F.min("doc_id").alias("keep")).agg(F.count("*").alias("n_texts"), F.sum("keep").alias("sum_ids"))


@query("""select doc_id, lang from (select doc_id, lang, row_number() over (partition by text order by n_chars desc, doc_id desc) rn from documents) where rn = 1""")
def dedupe_reviews(spark, d):
    """One row of each text. The key is a digest, so the window shuffles 32 bytes for each text and not the text."""
    keyed = table(spark, d, "documents").select("doc_id", "lang", "n_chars", F.sha2("text", 256).alias("text_key"))
    return latest_per_key(keyed, ["text_key"], ["n_chars", "doc_id"]).select("doc_id", "lang")


@query("""select event_id, user_id, cast(null as bigint) doc_id, cast(null as varchar) lang from events
    union all select null, null, doc_id, lang from documents""")
def union_chunks(spark, d):
    return union_by_name(table(spark, d, "events").select("event_id", "user_id"), table(spark, d, "documents").select("doc_id", "lang"))


# ---- tokens

STOP_SQL = ", ".join(f"'{w}'" for w in ENGLISH_STOPWORDS)


@query(f"""with w as (select doc_id, source, unnest(regexp_extract_all(lower(text), '[a-zA-Z]+')) token from documents where lang = 'en'),
  k as (select * from w where length(token) between 3 and 100 and token not in ({STOP_SQL})),
  c as (select source, token, cast(count(*) as bigint) frequency, cast(count(distinct doc_id) as bigint) review_appearances from k group by 1, 2)
  select source, token, frequency, review_appearances from (select *, row_number() over (partition by source order by frequency desc, token) rn from c) where rn <= 100""")
def morphemes_english(spark, d):
    docs = table(spark, d, "documents").where("lang = 'en'").select("source", "text")
    return gold.token_frequencies(docs, english_tokens(F.col("text")), ["source"], 100)


# ---- scalars


@query("""select event_id, cast(json_extract_string(props, '$.k') as int) k from events""")
def json_extract(spark, d):
    return table(spark, d, "events").select("event_id", safe_int(F.get_json_object("props", "$.k")).alias("k"))


@query("""select o_orderkey, cast(o_orderdate as date) release_date from orders""")
def date_parse(spark, d):
    kind = F.pmod("o_orderkey", F.lit(3))
    text = F.when(kind == 0, F.date_format("o_orderdate", "MMM d, yyyy")).when(kind == 1, F.date_format("o_orderdate", "d MMM, yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-M-d"))
    return table(spark, d, "orders").select("o_orderkey", release_date(F.concat(F.lit(" "), text)).alias("release_date"))


@query("""select event_id, try_cast(case when event_id % 3 = 0 then cast(event_id as varchar) when event_id % 3 = 1 then 'x' || event_id else '' end as int) n from events""")
def safe_int_parse(spark, d):
    kind = F.pmod("event_id", F.lit(3))
    text = F.when(kind == 0, F.col("event_id").cast("string")).when(kind == 1, F.concat(F.lit("x"), F.col("event_id"))).otherwise("")
    return table(spark, d, "events").select("event_id", safe_int(text).alias("n"))


@query("""select vec_id, embedding[1] first_value from embeddings""")
def array_first(spark, d):
    return table(spark, d, "embeddings").select("vec_id", first_or_null(F.col("embedding")).alias("first_value"))


@query("""select vec_id, unnest(range(0, len(embedding))) pos, unnest(embedding) item from embeddings""")
def explode_items(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "item")).withColumn("pos", F.col("pos").cast("long"))


@query("""select vec_id, len(list_filter(embedding, lambda x: x > 0)) n_positive from embeddings""")
def array_filter(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.size(F.filter("embedding", lambda x: x > 0)).cast("long").alias("n_positive"))


@query("""select doc_id, case when (case when lang = 'de' then 'koreana' else lang end) = 'koreana' then 'korean' else lang end "language" from documents""")
def lang_normalize(spark, d):
    raw = F.when(F.col("lang") == "de", "koreana").otherwise(F.col("lang"))
    return table(spark, d, "documents").select("doc_id", normalize_language(raw).alias("language"))


@query("""select event_id, date_trunc('second', ts) created_at, cast(year(ts) as int) review_year, cast(month(ts) as int) review_month from events""")
def epoch_to_ts(spark, d):
    created = epoch_to_timestamp(F.unix_timestamp(F.col("ts").cast("timestamp")))
    return table(spark, d, "events").select("event_id", created.cast("timestamp_ntz").alias("created_at"), F.year("ts").alias("review_year"), F.month("ts").alias("review_month"))


@query("""select event_id, strftime(ts, '%Y-%m') ym, lpad(cast(month(ts) as varchar), 2, '0') month_dir from events""")
def year_month(spark, d):
    return table(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM").alias("ym"), F.lpad(F.month("ts").cast("string"), 2, "0").alias("month_dir"))


@query("""select p_partkey, concat_ws(', ', p_brand, p_type) names from part""")
def join_names(spark, d):
    return table(spark, d, "part").select("p_partkey", joined_names(F.array("p_brand", "p_type")).alias("names"))


@query("""select event_id, coalesce(nullif(value, 0), 1) weight, case when value > 250 then 'discount' else 'normal' end ab_group from events""")
def conditional_label(spark, d):
    return table(spark, d, "events").select("event_id", F.coalesce(F.nullif("value", F.lit(0)), F.lit(1)).alias("weight"), F.when(F.col("value") > 250, "discount").otherwise("normal").alias("ab_group"))


@query("""select event_id, user_id author_user_id, event_type author_event_type from events""")
def struct_unnest(spark, d):
    e = table(spark, d, "events").select("event_id", F.struct("user_id", "event_type").alias("author"))
    return e.select("event_id", *[F.col(f"author.{f}").alias(f"author_{f}") for f in ("user_id", "event_type")])


@query("""select event_id, '*' missing, event_type found from events""")
def cursor_lookup(spark, d):
    cursors = F.create_map(F.lit("korean"), F.col("event_type"))
    return table(spark, d, "events").select("event_id", F.coalesce(F.try_element_at(cursors, F.lit("english")), F.lit("*")).alias("missing"), F.coalesce(F.try_element_at(cursors, F.lit("korean")), F.lit("*")).alias("found"))


# ---- loads that change only what they touch

#: Events as versions of reviews: two in a row of a region are one review, whose second version may have another language or day.
VERSIONS_SQL = """v as (select n_regionkey app_id, event_type "language", ts, event_id, value, (row_number() over (partition by n_regionkey order by event_id) - 1) k
    from events join customer on user_id = c_custkey join nation on n_nationkey = c_nationkey),
  l as (select *, row_number() over (partition by app_id, k // 2 order by event_id desc) rn from v),
  r as (select * from l where rn = 1 and app_id <> 0)"""


def _two_loads(spark: SparkSession, d: str) -> Storefront:
    """A shop whose lake took first versions and then second ones, with facts counted after each load; region 0 is no active game."""
    w = Window.partitionBy("n_regionkey").orderBy("event_id")
    v = table(spark, d, "events").join(table(spark, d, "customer"), F.col("user_id") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).withColumn("k", F.row_number().over(w) - 1)
    root = scratch_root(spark, "shop")
    v = v.select("k", "n_regionkey", "event_type", "ts", "event_id", "value")
    v.write.parquet(f"{root}/numbered")  # each load reads its rows twice, and numbering takes one task for each region
    v = spark.read.schema(v.schema).parquet(f"{root}/numbered")
    minutes = F.floor("value").cast("int")
    given = {
        "recommendationid": F.floor(F.col("k") / 2).cast("string"), "language": F.col("event_type"), "timestamp_created": F.unix_timestamp(F.col("ts").cast("timestamp")), "timestamp_updated": F.col("event_id"),
        "author": F.struct(*[(minutes if f.startswith("playtime") else F.lit(None)).alias(f) for f in silver.AUTHOR_FIELDS]), "appid": F.col("n_regionkey"), "review": F.lit(""),
    }
    kinds = spark.createDataFrame([], REVIEWS).schema
    rows = v.select("k", *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds])
    shop = Storefront(spark, f"{root}/bronze", f"{root}/warehouse", index_buckets=8)
    games = table(spark, d, "region").select(F.col("r_regionkey").alias("appid"), *[F.lit(None).cast("date").alias(c) for c in ("first_seen", "last_discounted")], (F.col("r_regionkey") != 0).alias("is_active"), F.lit(True).alias("collect_reviews"), F.lit(True).alias("collect_players"), F.lit(None).cast("timestamp").alias("reviews_collected_at"), F.create_map().cast("map<string,string>").alias("review_cursors"))
    shop.save("tracked_games", games)
    for part in (0, 1):
        shop.add_reviews(rows.where(F.col("k") % 2 == part).drop("k"))
        shop.load_review_facts()
    return shop


@query(f"""with {VERSIONS_SQL} select app_id, "language", cast(ts as date) review_date, cast((200 * sum(cast(floor(value) as bigint)) + count(*)) // (2 * count(*)) as bigint) avg_cents,
    cast(count(*) as int) review_count, cast(count(*) as int) reviews_with_time from r group by 1, 2, 3""")
def incremental_review_facts(spark, d):
    """Both daily facts behind two loads, of which the second moves reviews: counted as one load of the last versions would be."""
    shop = _two_loads(spark, d)
    counts = shop.table("fact_review_daily").drop("updated_at")
    played = shop.table("fact_review_playtime_daily").select("app_id", "language", "review_date", (F.col("avg_playtime_at_review") * 100).cast("long").alias("avg_cents"), F.col("review_count").alias("reviews_with_time"))
    return counts.join(played, ["app_id", "language", "review_date"], "full_outer")


@query(f"""with {VERSIONS_SQL} select app_id, k // 2 review, "language", year(ts) "year", month(ts) "month", event_id from l where rn = 1""")
def lake_last_versions(spark, d):
    """All rows of the lake behind both loads, with the partitions that they lie in."""
    rows = _two_loads(spark, d).lake.rows()
    return rows.select(F.col("appid").alias("app_id"), F.col("recommendationid").cast("long").alias("review"), "language", F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"), F.unix_seconds("timestamp_updated").alias("event_id"))


@query("""select l_partkey app_id, cast(l_shipdate as date) collected_at, cast(round(l_discount * 100) as int) discount_percent, l_orderkey, l_linenumber
  from (select *, row_number() over (partition by l_partkey, cast(l_shipdate as date) order by l_linenumber desc, l_orderkey desc) rn from lineitem) where rn = 1""")
def merge_by_day(spark, d):
    """Line items by number, one load after the other, each merged into the days that it touches."""
    from ..operators.journal import Journal

    items = table(spark, d, "lineitem").select(F.col("l_partkey").alias("app_id"), F.to_date("l_shipdate").alias("collected_at"), F.round(F.col("l_discount") * 100).cast("int").alias("discount_percent"), "l_orderkey", "l_linenumber")
    keys, values = ["app_id", "collected_at"], ["discount_percent", "l_orderkey", "l_linenumber"]
    root = scratch_root(spark, "prices")
    journal, path = Journal(spark, root), f"{root}/prices"
    kinds = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in items.schema)}, day string"
    month = F.date_format("collected_at", "yyyy-MM").alias("day")
    for half in (F.col("l_linenumber") <= 3, F.col("l_linenumber") > 3):
        rows = items.where(half)
        change, days = journal.begin(), [r["day"] for r in rows.select(month).distinct().collect()]
        old = spark.read.schema(kinds).parquet(path).where(F.col("day").isin(days)).drop("day") if journal.files.exists(path) else items.limit(0)
        change.replace_partitions(upsert(old, rows, keys, values, order=["l_linenumber", "l_orderkey"]).withColumn("day", month), path, ["day"])
        change.commit()
    return spark.read.schema(kinds).parquet(path).drop("day")


@query(f"""with w as (select doc_id, source, unnest(regexp_extract_all(lower(text), '[a-zA-Z]+')) token from documents where lang = 'en'),
  k as (select * from w where length(token) between 3 and 100 and token not in ({STOP_SQL})),
  c as (select cast(substr(source, 4) as int) app_id, token morpheme, cast(count(*) as int) frequency, cast(count(distinct doc_id) as int) review_appearances from k group by 1, 2)
  select * from (select *, row_number() over (partition by app_id order by frequency desc, morpheme) rn from c) where rn <= 100""")
def incremental_tokens(spark, d):
    """Documents as reviews of two loads, each of which counts the tokens of the partitions that it touches."""
    docs = table(spark, d, "documents").where("lang = 'en'").select(F.expr("cast(substr(source, 4) as int)").alias("appid"), F.lit("english").alias("language"), F.col("doc_id").cast("string").alias("recommendationid"), F.col("text").alias("review"), F.lit(86400).cast("long").alias("timestamp_created"), F.lit(0).cast("long").alias("timestamp_updated"), "doc_id")
    kinds = spark.createDataFrame([], REVIEWS).schema
    rows = docs.select("doc_id", *[(F.col(f.name) if f.name in docs.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds])
    half = docs.agg(F.expr("percentile_approx(doc_id, 0.5)")).first()[0]
    root = scratch_root(spark, "tokens")
    shop = Storefront(spark, f"{root}/bronze", f"{root}/warehouse", index_buckets=8)
    shop.save("tracked_games", silver.merge_tracked(shop.table("tracked_games"), docs.select("appid").distinct(), date(2025, 1, 1)))
    for load in (F.col("doc_id") <= half, F.col("doc_id") > half):
        shop.add_reviews(rows.where(load).drop("doc_id"))
        shop.load_tokens(100)
    top = shop.table("gold_review_morphemes")
    numbered = F.row_number().over(Window.partitionBy("app_id").orderBy(F.desc("frequency"), "morpheme")).cast("long").alias("rn")
    return top.select("app_id", "morpheme", "frequency", "review_appearances", numbered)


PLAYED_SQL = """d as (select user_id app_id, event_type "language", cast(ts as date) review_date, cast(count(*) as bigint) n,
    cast((200 * sum(cast(floor(value) as bigint)) + count(*)) // (2 * count(*)) as bigint) cents from events group by 1, 2, 3)"""


def _played(spark, d):
    minutes = F.floor("value").cast("int")
    lake = table(spark, d, "events").select(F.col("user_id").alias("appid"), F.col("event_type").alias("language"), F.col("ts").alias("timestamp_created"), minutes.alias("author_playtime_at_review"), (2 * minutes).alias("author_playtime_forever"))
    return silver.review_playtime_daily(lake)


@query(f"""with {PLAYED_SQL} select app_id, "language", review_date, cents avg_cents, n review_count from d""")
def playtime_daily_minutes(spark, d):
    return _played(spark, d).select("app_id", "language", "review_date", (F.col("avg_playtime_at_review") * 100).cast("long").alias("avg_cents"), F.col("review_count").cast("long").alias("review_count"))


@query(f"""with {PRICE_SQL}, {PLAYED_SQL}, r as (select app_id, review_date "date", cast(sum(n) as bigint) total_review_count,
    cast((2 * sum(n * cents) + sum(n)) // (2 * sum(n)) as bigint) min_cents from d group by 1, 2)
  select r.app_id, game_name, "date", min_cents, total_review_count, coalesce(is_discounted, false) is_discounted, coalesce(discount_percent, 0) discount_percent,
    case when coalesce(is_discounted, false) then 'discount' else 'normal' end ab_group
  from r left join p on r.app_id = p.app_id and "date" = price_date left join g on r.app_id = c_custkey""")
def playtime_trend_minutes(spark, d):
    """The playtime mart itself over whole minutes; its baseline is compared in ``discount_playtime_trend``."""
    prices = _prices(spark, d).withColumns({"initial_price": F.lit(None).cast("int"), "final_price": F.lit(None).cast("int"), "discount_end_at": F.lit(None).cast("timestamp")})
    out = marts.mart_discount_playtime_trend(_played(spark, d), prices, _games(spark, d))
    return out.select("app_id", "game_name", "date", (F.col("avg_playtime_at_review_min") * 100).cast("long").alias("min_cents"), "total_review_count", "is_discounted", "discount_percent", "ab_group")


@query("""select c_custkey appid, cast(max(o_orderdate) as date) last_discounted from customer left join orders on c_custkey = o_custkey
  where c_acctbal > 0 and c_mktsegment <> 'MACHINERY' group by 1 order by 2 desc nulls first, 1 limit 50""")
def crawl_targets(spark, d):
    """The games that a crawl would take: customers with both flags, the last discounted ones first; the limit is the feature."""
    last = table(spark, d, "orders").groupBy("o_custkey").agg(F.to_date(F.max("o_orderdate")).alias("last_discounted"))
    control = table(spark, d, "customer").join(last, F.col("c_custkey") == F.col("o_custkey"), "left").select(F.col("c_custkey").alias("appid"), "last_discounted", (F.col("c_acctbal") > 0).alias("is_active"), (F.col("c_mktsegment") != "MACHINERY").alias("collect_reviews"))
    return bronze.crawl_targets(control, "collect_reviews", limit=50).select("appid", "last_discounted")


@query("""with c as (select user_id, event_type, max(event_id) id from events group by 1, 2)
  select c_custkey appid, event_type "language", coalesce(cast(id as varchar), 'start') "cursor" from customer cross join (select distinct event_type from events) left join c using (event_type)
  where user_id = c_custkey union all select c_custkey, 'none', 'start' from customer""")
def cursors_kept(spark, d):
    """The control table's cursors behind two crawls, looked up by language."""
    events = table(spark, d, "events").select(F.col("user_id").alias("appid"), F.col("event_type").alias("language"), "event_id")
    tracked = silver.merge_tracked(spark.createDataFrame([], "appid long, first_seen date, last_discounted date, is_active boolean, collect_reviews boolean, collect_players boolean, reviews_collected_at timestamp, review_cursors map<string,string>"), table(spark, d, "customer").select(F.col("c_custkey").alias("appid")), date(2025, 1, 1))
    for crawl in (F.col("language").isin("view", "click"), F.lit(True)):
        tracked = silver.merge_cursors(tracked, events.where(crawl).groupBy("appid", "language").agg(F.max("event_id").cast("string").alias("cursor")))
    found = tracked.select("appid", F.explode(F.map_concat("review_cursors", F.create_map(F.lit("none"), F.lit("start")))).alias("language", "cursor"))
    return found.select("appid", "language", "cursor")


@query("""select user_id "key", cast(ts as date) "day", cast(count(*) as bigint) n from events group by 1, 2""")
def daily_with_corrections(spark, d):
    """Events in the order of their values, so most come late: days that were closed, corrections of them and open days add up to the whole count."""
    from ..streaming.corrections import DailyCounts

    events = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = DailyCounts(spark, scratch_root(spark, "daily"), "user_id", "ts", 5)
    low, high = events.agg(F.percentile_approx("value", [0.33, 0.67])).first()[0]
    for batch, rows in enumerate((F.col("value") <= low, (F.col("value") > low) & (F.col("value") <= high), (F.col("value") > high) | F.col("value").isNull())):
        counts(events.where(rows), batch)
    return counts.totals()
