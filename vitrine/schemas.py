"""Declared schemas of every feed and table; nothing is inferred at read time.

Fields whose type drifts between chunks are declared as strings and are cast
with ``try_cast`` in the silver plans.
"""

DISCOUNT_GAMES = (
    "response STRUCT<ids: ARRAY<STRUCT<appid: INT>>, store_items: ARRAY<STRUCT<appid: INT, name: STRING, is_free: BOOLEAN, "
    "best_purchase_option: STRUCT<original_price_in_cents: STRING, final_price_in_cents: STRING, discount_pct: INT, "
    "active_discounts: ARRAY<STRUCT<discount_end_date: BIGINT>>>>>>"
)
PLAYER_COUNTS = "appid INT, player_count INT, collected_at STRING"
APP_DETAILS = (
    "appid INT, name STRING, type STRING, is_free BOOLEAN, required_age INT, short_description STRING, developers STRING, "
    "publishers STRING, genres ARRAY<STRUCT<genre_id: INT, genre_name: STRING>>, platforms_windows BOOLEAN, platforms_mac BOOLEAN, "
    "platforms_linux BOOLEAN, header_image STRING, release_date_coming_soon BOOLEAN, release_date_str STRING, "
    "recommendations_total INT, collected_at STRING"
)
#: What the detail endpoint answers for one app, before it is flattened.
RAW_DETAILS = (
    "name STRING, type STRING, is_free BOOLEAN, required_age STRING, short_description STRING, "
    "developers ARRAY<STRING>, publishers ARRAY<STRING>, genres ARRAY<STRUCT<id: STRING, description: STRING>>, "
    "platforms STRUCT<windows: BOOLEAN, mac: BOOLEAN, linux: BOOLEAN>, header_image STRING, "
    "release_date STRUCT<coming_soon: BOOLEAN, date: STRING>, recommendations STRUCT<total: INT>"
)
AUTHOR = "STRUCT<steamid: STRING, playtime_forever: INT, playtime_at_review: INT, playtime_last_two_weeks: INT, num_games_owned: INT, num_reviews: INT>"
REVIEWS = (
    f"recommendationid STRING, author {AUTHOR}, language STRING, review STRING, timestamp_created BIGINT, timestamp_updated BIGINT, "
    "voted_up BOOLEAN, votes_up INT, votes_funny INT, weighted_vote_score STRING, steam_purchase BOOLEAN, received_for_free BOOLEAN, "
    "written_during_early_access BOOLEAN, appid INT"
)

TRACKED_GAMES = (
    "appid INT, first_seen DATE, last_discounted DATE, is_active BOOLEAN, collect_reviews BOOLEAN, collect_players BOOLEAN, "
    "reviews_collected_at TIMESTAMP, review_cursors MAP<STRING,STRING>"
)
DIM_GAMES = (
    "app_id INT, name STRING, type STRING, is_free BOOLEAN, required_age INT, developers STRING, publishers STRING, release_date DATE, "
    "platforms_windows BOOLEAN, platforms_mac BOOLEAN, platforms_linux BOOLEAN, header_image_url STRING, total_reviews INT, "
    "total_recommendations INT, created_at TIMESTAMP, updated_at TIMESTAMP"
)
DIM_GENRES = "genre_id INT, genre_name STRING"
DIM_GAME_GENRES = "app_id INT, genre_id INT"
FACT_PLAYERS = "app_id INT, rank INT, concurrent_in_game INT, peak_in_game INT, collected_at TIMESTAMP, api_last_update TIMESTAMP"
FACT_PRICE = (
    "app_id INT, currency STRING, initial_price INT, final_price INT, discount_percent INT, is_free BOOLEAN, "
    "discount_end_at TIMESTAMP, collected_at DATE"
)
FACT_REVIEW_DAILY = "app_id INT, language STRING, review_date DATE, review_count INT, updated_at TIMESTAMP"
FACT_PLAYTIME_DAILY = (
    "app_id INT, language STRING, review_date DATE, avg_playtime_at_review DECIMAL(10,2), avg_playtime_forever DECIMAL(10,2), "
    "review_count INT, updated_at TIMESTAMP"
)
GOLD_TOKENS = (
    "app_id INT, language STRING, morpheme STRING, frequency INT, review_appearances INT, earliest_review_at TIMESTAMP, "
    "latest_review_at TIMESTAMP, updated_at TIMESTAMP"
)
