"""The whole flow on raw files written from the sf0.001 tables."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from playlens.operators import engagement as eng
from playlens.plans import catalogues as C
from playlens.plans import jobs
from playlens.plans import roles as R
from playlens.sources import keyed
from tests.conftest import SF_SMALL


def _write_array(path, json_rows):
    with open(path, "w") as f:
        f.write("[\n" + ",\n".join(json_rows) + "\n]\n")


def test_end_to_end_flow(spark):
    root = tempfile.mkdtemp(prefix="pl-flow-")
    p = lambda *a: os.path.join(root, *a)
    os.makedirs(p("raw_a")), os.makedirs(p("raw_b")), os.makedirs(p("libs"))
    raw_a = C.raw_catalogue_a(spark, SF_SMALL).withColumn(
        "external_games", F.array(F.struct(F.col("id").cast("string").alias("uid"),
                                           F.struct(F.lit("Steam").alias("name")).alias("external_game_source"))))
    _write_array(p("raw_a", "page0.json"), raw_a.drop("game_type").toJSON().collect())
    _write_array(p("raw_b", "page0.json"), C.raw_catalogue_b(spark, SF_SMALL).toJSON().collect())
    rows = R.purchase_rows(spark, SF_SMALL).join(
        R.items(spark, SF_SMALL).select("item_id", "item_name"), "item_id").select(
        F.col("user_id").cast("string").alias("user_id"), F.col("item_id").alias("appid"),
        F.col("item_name").alias("name"), F.col("playtime_forever").cast("long").alias("playtime_forever"),
        F.col("playtime_2weeks").cast("long").alias("playtime_2weeks"))
    libs = eng.library_envelope(rows, "user_id", ["appid", "name", "playtime_forever", "playtime_2weeks"],
                                "appid", max_items=500)
    for r in libs.collect():
        with open(p("libs", f"{r.user_id}.json"), "w") as f:
            f.write(json.dumps({"steam_id": r.user_id, "scraped_at": "2024-01-01T00:00:00",
                                "games": [g.asDict() for g in r.games]}))

    assert jobs.format_job(spark, p("raw_a", "*.json"), p("silver_a"), "initial", "a") > 0
    assert jobs.format_job(spark, p("raw_b", "*.json"), p("silver_b"), "initial", "b") > 0
    assert jobs.libraries_job(spark, p("libs"), p("silver_libs"), p("ck_libs"))["batches"] >= 1
    counts = jobs.combine_job(spark, p("silver_a"), p("silver_b"), p("silver_libs"), p("master"),
                              p("interactions"), max_tag_freq=150)
    assert counts["master"] > 0 and counts["interactions"] > 0
    master = keyed.read_keyed(spark, p("master"))
    assert master.groupBy("igdb_id").count().filter("count > 1").count() == 0
    out = jobs.train_job(spark, p("interactions"), p("recs"), k=4, min_df=2, min_users=5, min_share=0.05,
                         min_score=0.5, libraries=p("silver_libs"))
    assert out["users"] > 0 and -1 <= out["silhouette"] <= 1
    recs = spark.read.parquet(p("recs"))
    assert recs.filter(F.size("recommended_games") > 10).count() == 0
    owned = spark.read.parquet(p("interactions")).select("steam_id", "steam_appid")
    got = recs.select("steam_id", F.explode("recommended_ids").alias("steam_appid"))
    assert got.join(owned, ["steam_id", "steam_appid"]).count() == 0
    served = jobs.serve_jobs(spark, p("master"), p("recs"), p("idx_games"), p("idx_recs"))
    assert served["catalogue_docs"] == counts["master"] and served["recommendation_docs"] == out["users"]
    # a second combine upserts the same keys
    again = jobs.combine_job(spark, p("silver_a"), p("silver_b"), p("silver_libs"), p("master"), p("interactions"),
                     max_tag_freq=150)
    assert again == counts
