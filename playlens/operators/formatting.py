"""O1/O2: raw nested catalogue records -> flat, typed silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions.nested import fill_defaults, first_where, pluck, pluck_where
from playlens.functions.scalar import epoch_ts, safe_cast, safe_date, safe_ts
from playlens.operators.topk import dedupe

CATALOGUE_A_DEFAULTS = {"summary": "", "storyline": "", "rating": 0.0, "rating_count": 0,
                        "hypes": 0, "follows": 0}
CATALOGUE_B_DEFAULTS = {"rating": 0.0, "metacritic": 0, "playtime": 0, "status_owned": 0,
                        "status_beaten": 0, "status_dropped": 0, "status_toplay": 0}

# Fixed value: the external source name that identifies the store app id.
STORE_SOURCE = "Steam"
# Fixed value: language code of the tags kept from catalogue B.
TAG_LANGUAGE = "eng"


def format_catalogue_a(raw: DataFrame, dedupe_ids: bool = True) -> DataFrame:
    """O1.  Rows without an id (malformed records) are dropped; duplicates of
    an id keep the most recently updated record (then the highest rating
    count) instead of an arbitrary one."""
    df = raw.filter(F.col("id").isNotNull())
    if dedupe_ids:
        df = dedupe(df, ["id"], [F.col("updated_at").desc_nulls_last(),
                                 F.col("rating_count").desc_nulls_last(), F.col("name").asc()])
    out = df.select(
        F.col("id").cast("long").alias("id"), "name", "slug", "summary", "storyline",
        epoch_ts("first_release_date").alias("release_date"),
        epoch_ts("updated_at").alias("updated_at"),
        pluck("genres", "name").alias("genre_names"),
        pluck("themes", "name").alias("theme_names"),
        pluck("game_modes", "name").alias("game_mode_names"),
        pluck("platforms", "name").alias("platform_names"),
        pluck("keywords", "name").alias("keyword_names"),
        pluck_where("involved_companies", lambda x: x["developer"] == F.lit(True), "company.name")
        .alias("developers"),
        pluck_where("involved_companies", lambda x: x["publisher"] == F.lit(True), "company.name")
        .alias("publishers"),
        safe_cast("rating", "float").alias("rating"),
        safe_cast("rating_count", "int").alias("rating_count"),
        safe_cast("total_rating", "float").alias("total_rating"),
        safe_cast("total_rating_count", "int").alias("total_rating_count"),
        safe_cast("aggregated_rating", "float").alias("aggregated_rating"),
        safe_cast("aggregated_rating_count", "int").alias("aggregated_rating_count"),
        safe_cast("hypes", "int").alias("hypes"),
        safe_cast("follows", "int").alias("follows"),
        F.col("collection.name").alias("collection_name"),
        pluck("franchises", "name").alias("franchise_names"),
        pluck("similar_games", "name").alias("similar_game_names"),
        first_where("external_games",
                    lambda x: x["external_game_source"]["name"] == F.lit(STORE_SOURCE),
                    "uid", cast="long").alias("steam_appid"),
    )
    return fill_defaults(out, CATALOGUE_A_DEFAULTS)


def format_catalogue_b(raw: DataFrame, dedupe_ids: bool = True) -> DataFrame:
    """O2.  Dates and instants are parsed leniently (malformed -> NULL)."""
    df = raw.filter(F.col("id").isNotNull())
    if dedupe_ids:
        df = dedupe(df, ["id"], [safe_ts("updated").desc_nulls_last(),
                                 F.col("rating").desc_nulls_last(), F.col("name").asc()])
    out = df.select(
        "id", "name", "slug",
        safe_date("released").alias("release_date"),
        safe_ts("updated").alias("updated_at"),
        safe_cast("rating", "float").alias("rating"),
        safe_cast("metacritic", "int").alias("metacritic"),
        safe_cast("playtime", "int").alias("playtime"),
        F.col("added").alias("total_added"), "ratings_count", "reviews_count",
        F.col("added_by_status.owned").alias("status_owned"),
        F.col("added_by_status.beaten").alias("status_beaten"),
        F.col("added_by_status.dropped").alias("status_dropped"),
        F.col("added_by_status.toplay").alias("status_toplay"),
        pluck("genres", "name").alias("genre_names"),
        pluck("platforms", "platform.name").alias("platform_names"),
        pluck("stores", "store.name").alias("store_names"),
        pluck_where("tags", lambda x: x["language"] == F.lit(TAG_LANGUAGE), "name").alias("tag_names"),
        F.col("esrb_rating.name").alias("esrb_rating_name"),
    )
    return fill_defaults(out, CATALOGUE_B_DEFAULTS)
