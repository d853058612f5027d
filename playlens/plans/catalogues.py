"""Raw nested catalogue records derived from ``part`` (for O1, O2, O5).

The raw shapes are those of the two source catalogues (arrays of structs,
struct-of-struct, epoch seconds, ISO text).  Values are functions of each
part row, with stale duplicate records, malformed ids/dates and missing
fields mixed in so that de-duplication and lenient parsing are exercised.
Everything is column expressions over the scan: no grouping, no collection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.operators.formatting import format_catalogue_a, format_catalogue_b
from playlens.plans.roles import table
from playlens.session import materialize

EPOCH_2000 = 946684800
YEAR_SECONDS = 31536000


#: Rows of ``part`` that one task shapes into records.
PART_ROWS = 50_000


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part``, dealt into tasks by its number of rows: a small file of narrow rows is one
    scan task, but its records are many times larger."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    n = -(-p.count() // PART_ROWS)      # from the file footers
    return p.repartition(n) if n > 1 else p


def _name_structs(arr):
    return F.transform(arr, lambda w: F.struct(w.alias("name")))


def raw_catalogue_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parts(spark, sf_dir)
    no_kw = F.lit(None).cast("array<struct<name:string>>")
    fresh = p.select(
        F.when(F.col("p_size") == 50, F.lit(None).cast("long")).otherwise(F.col("p_partkey")).alias("id"),
        F.col("p_name").alias("name"),
        F.lower(F.regexp_replace("p_name", " ", "-")).alias("slug"),
        F.when(F.col("p_size") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("About "), "p_name"))
        .alias("summary"),
        F.lit(None).cast("string").alias("storyline"),
        F.struct(F.col("p_type").alias("name")).alias("collection"),
        _name_structs(F.split("p_name", " ")).alias("genres"),
        F.array(F.struct(F.col("p_brand").alias("name"))).alias("themes"),
        F.array(F.struct(F.lit("Single player").alias("name"))).alias("game_modes"),
        F.array(F.struct(F.col("p_type").alias("name"),
                         F.substring("p_type", 1, 3).alias("abbreviation"))).alias("platforms"),
        F.when(F.col("p_size") % 5 == 0, no_kw)
        .otherwise(F.array(F.struct(F.col("p_brand").alias("name")))).alias("keywords"),
        F.array().cast("array<struct<name:string>>").alias("franchises"),
        F.array(F.struct(F.col("p_name").alias("name"))).alias("similar_games"),
        F.array(
            F.struct((F.col("p_size") % 2 == 0).alias("developer"), (F.col("p_size") % 3 == 0).alias("publisher"),
                     F.struct(F.col("p_brand").alias("name")).alias("company")),
            F.struct(F.lit(True).alias("developer"), F.lit(None).cast("boolean").alias("publisher"),
                     F.struct(F.concat(F.lit("Maker#"), F.col("p_size").cast("string")).alias("name"))
                     .alias("company"))).alias("involved_companies"),
        F.array(
            F.struct(F.when(F.col("p_partkey") % 10 == 0, F.lit("abc"))
                     .otherwise(F.col("p_partkey").cast("string")).alias("uid"),
                     F.struct(F.when(F.col("p_partkey") % 3 == 0, F.lit("Other")).otherwise(F.lit("Steam"))
                              .alias("name")).alias("external_game_source")),
            F.struct((F.col("p_partkey") + 7).cast("string").alias("uid"),
                     F.struct(F.lit("Other").alias("name")).alias("external_game_source")))
        .alias("external_games"),
        (F.lit(EPOCH_2000) + F.col("p_size").cast("long") * YEAR_SECONDS + F.col("p_partkey"))
        .alias("first_release_date"),
        (F.lit(1700000000) + F.col("p_partkey")).alias("updated_at"),
        (F.col("p_retailprice") / 20.0).alias("rating"),
        F.col("p_size").cast("long").alias("rating_count"),
        (F.col("p_retailprice") / 25.0).alias("aggregated_rating"),
        (F.col("p_size") + 1).cast("long").alias("aggregated_rating_count"),
        (F.col("p_retailprice") / 22.0).alias("total_rating"),
        (F.col("p_size") + 2).cast("long").alias("total_rating_count"),
        F.col("p_size").alias("hypes"),
        F.when(F.col("p_size") > 45, F.lit(None).cast("int")).otherwise(F.col("p_size") * 10).alias("follows"),
        (F.col("p_size") % 10).alias("game_type"),
    )
    stale = (fresh.filter(F.col("rating_count") <= 5)
             .withColumn("updated_at", F.lit(1600000000) + F.col("id"))
             .withColumn("rating", F.lit(0.0)))
    return fresh.unionByName(stale)


def raw_catalogue_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parts(spark, sf_dir)
    year = (F.lit(2000) + F.col("p_size") % 25).cast("string")
    released = F.when(F.col("p_partkey") % 7 == 0, F.lit("2024-02-30")).otherwise(F.concat(year, F.lit("-01-15")))
    fresh = p.select(
        (F.col("p_partkey") + 1_000_000).alias("id"),
        F.lower(F.regexp_replace("p_name", " ", "-")).alias("slug"),
        F.concat(F.upper(F.regexp_replace("p_name", " ", ": ")), F.lit("!")).alias("name"),
        F.col("p_size").alias("playtime"),
        released.alias("released"),
        F.when(F.col("p_partkey") % 11 == 0, F.lit("")).otherwise(F.concat(year, F.lit("-06-01T10:00:00")))
        .alias("updated"),
        (F.col("p_retailprice") / 400.0).alias("rating"),
        F.lit(5).alias("rating_top"),
        (F.col("p_size") * 3).alias("ratings_count"),
        F.col("p_size").alias("reviews_count"),
        F.when(F.col("p_size") > 40, F.lit(None).cast("int")).otherwise(F.col("p_size") + 50).alias("metacritic"),
        F.lit(0).alias("suggestions_count"),
        (F.col("p_size") * 10).alias("added"),
        F.lit(False).alias("tba"),
        F.struct(F.lit(1).alias("yet"), (F.col("p_size") * 2).alias("owned"), F.col("p_size").alias("beaten"),
                 F.when(F.col("p_size") % 2 == 1, F.lit(None).cast("int")).otherwise(F.lit(3)).alias("toplay"),
                 (F.col("p_size") % 4).alias("dropped"), F.lit(0).alias("playing")).alias("added_by_status"),
        F.array(F.struct(F.struct(F.col("p_type").alias("name"), F.lower("p_type").alias("slug"))
                         .alias("platform"))).alias("platforms"),
        F.transform(F.split("p_name", " "), lambda w: F.struct(w.alias("name"), w.alias("slug"))).alias("genres"),
        F.array(F.struct(F.col("p_brand").alias("name"), F.lower("p_brand").alias("slug"),
                         F.lit("eng").alias("language")),
                F.struct(F.col("p_type").alias("name"), F.lower("p_type").alias("slug"),
                         F.lit("fra").alias("language"))).alias("tags"),
        F.array(F.struct(F.struct(F.concat(F.lit("Store#"), (F.col("p_size") % 3).cast("string"))
                                  .alias("name")).alias("store"))).alias("stores"),
        F.when(F.col("p_size") % 2 == 0, F.struct(F.lit("Teen").alias("name")))
        .otherwise(F.lit(None).cast("struct<name:string>")).alias("esrb_rating"),
    )
    stale = (fresh.filter(F.col("reviews_count") <= 5)
             .withColumn("updated", F.lit("1999-01-01T00:00:00"))
             .withColumn("rating", F.lit(0.0)))
    return fresh.unionByName(stale)


def silver_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted catalogue A in two loads: the bulk ``initial`` and one daily
    load re-rating the items of size > 40."""
    # the bulk load and the daily load both come from one formatting pass
    base = materialize(format_catalogue_a(raw_catalogue_a(spark, sf_dir)), "silver-a")
    daily = (base.filter(F.col("rating_count") > 40)
             .withColumn("rating", (F.col("rating") * 2).cast("float"))
             .withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 DAY")))
    return base.withColumn("dt", F.lit("initial")).unionByName(daily.withColumn("dt", F.lit("20240101")))


def silver_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_catalogue_b(raw_catalogue_b(spark, sf_dir)).withColumn("dt", F.lit("initial"))
