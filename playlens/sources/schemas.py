"""Raw input schemas (fixed values: field names and types of the source JSON)."""

# Catalogue A: pretty-printed JSON array per file.
CATALOGUE_A_SCHEMA = """
id BIGINT, name STRING, slug STRING, summary STRING, storyline STRING,
collection STRUCT<name: STRING>, parent_game STRUCT<name: STRING>, version_parent STRUCT<name: STRING>,
genres ARRAY<STRUCT<name: STRING>>, themes ARRAY<STRUCT<name: STRING>>,
game_modes ARRAY<STRUCT<name: STRING>>, player_perspectives ARRAY<STRUCT<name: STRING>>,
keywords ARRAY<STRUCT<name: STRING>>, game_engines ARRAY<STRUCT<name: STRING>>,
franchises ARRAY<STRUCT<name: STRING>>, similar_games ARRAY<STRUCT<name: STRING>>,
remakes ARRAY<STRUCT<name: STRING>>, remasters ARRAY<STRUCT<name: STRING>>,
expansions ARRAY<STRUCT<name: STRING>>, standalone_expansions ARRAY<STRUCT<name: STRING>>,
platforms ARRAY<STRUCT<name: STRING, abbreviation: STRING>>,
involved_companies ARRAY<STRUCT<developer: BOOLEAN, publisher: BOOLEAN, company: STRUCT<name: STRING>>>,
release_dates ARRAY<STRUCT<human: STRING, platform: STRUCT<name: STRING>>>,
age_ratings ARRAY<STRUCT<rating: INT, category: INT>>,
external_games ARRAY<STRUCT<uid: STRING, external_game_source: STRUCT<name: STRING>>>,
first_release_date BIGINT, updated_at BIGINT,
rating DOUBLE, rating_count BIGINT, aggregated_rating DOUBLE, aggregated_rating_count BIGINT,
total_rating DOUBLE, total_rating_count BIGINT, hypes INT, follows INT
"""

# Catalogue B: same framing.
CATALOGUE_B_SCHEMA = """
id BIGINT, slug STRING, name STRING, playtime INT, released STRING, updated STRING,
rating DOUBLE, rating_top INT, ratings_count INT, reviews_count INT, metacritic INT,
suggestions_count INT, added INT, tba BOOLEAN,
added_by_status STRUCT<yet: INT, owned: INT, beaten: INT, toplay: INT, dropped: INT, playing: INT>,
platforms ARRAY<STRUCT<platform: STRUCT<name: STRING, slug: STRING>>>,
genres ARRAY<STRUCT<name: STRING, slug: STRING>>,
tags ARRAY<STRUCT<name: STRING, slug: STRING, language: STRING>>,
stores ARRAY<STRUCT<store: STRUCT<name: STRING>>>,
esrb_rating STRUCT<name: STRING>
"""

# User library: one single-line JSON object per file.
LIBRARY_SCHEMA = """
steam_id STRING, scraped_at STRING,
games ARRAY<STRUCT<appid: BIGINT, name: STRING, playtime_forever: BIGINT, playtime_2weeks: BIGINT,
  img_icon_url: STRING, has_community_visible_stats: BOOLEAN, has_leaderboards: BOOLEAN,
  content_descriptorids: ARRAY<BIGINT>>>
"""

# Formatted catalogue A as read back by the combine step (partition column last).
CATALOGUE_A_SILVER_SCHEMA = """
id BIGINT, name STRING, slug STRING, summary STRING, storyline STRING,
release_date TIMESTAMP, updated_at TIMESTAMP,
genre_names ARRAY<STRING>, theme_names ARRAY<STRING>, game_mode_names ARRAY<STRING>,
platform_names ARRAY<STRING>, keyword_names ARRAY<STRING>,
developers ARRAY<STRING>, publishers ARRAY<STRING>,
rating FLOAT, rating_count INT, total_rating FLOAT, total_rating_count INT,
aggregated_rating FLOAT, aggregated_rating_count INT, hypes INT, follows INT,
collection_name STRING, franchise_names ARRAY<STRING>, similar_game_names ARRAY<STRING>,
steam_appid BIGINT, dt STRING
"""
