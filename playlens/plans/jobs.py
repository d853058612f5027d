"""The end-to-end flow over storage paths, in the reference's job order:

format catalogues (O1, O2) and consolidate libraries (O3) -> combine into
the master catalogue and scored interactions (O4, O5, O6) -> learn cohorts,
profile them and recommend (O7, O8, O9) -> serve documents (O10).

Each job reads its inputs, returns early on empty input, writes its output
and reports counts taken while it is written, so nothing is computed or read
again for reporting.  Thresholds are parameters with the reference's defaults.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from playlens.operators import cohorts as coh
from playlens.operators import engagement as eng
from playlens.operators import features as feat
from playlens.operators import recommend as rec
from playlens.operators.formatting import format_catalogue_a, format_catalogue_b
from playlens.operators.resolve import as_of_filter, master_catalogue
from playlens.operators.similarity import compute_similar_games
from playlens.operators.topk import dedupe
from playlens.session import materialize
from playlens.sources import keyed, sinks
from playlens.sources.readers import has_rows, read_gold, read_raw_json, read_silver
from playlens.sources.schemas import CATALOGUE_A_SCHEMA, CATALOGUE_A_SILVER_SCHEMA, CATALOGUE_B_SCHEMA
from playlens.streaming.loads import consolidate_libraries

TAG_COLS = ["genre_names", "theme_names", "tag_names"]


def format_job(spark: SparkSession, raw_path: str, silver_root: str, dt: str, source: str,
               multiline: bool = True, files: int | None = None) -> int:
    """O1/O2 + K1: one load of a raw catalogue into its ``dt=`` partition."""
    schema = CATALOGUE_A_SCHEMA if source == "a" else CATALOGUE_B_SCHEMA
    raw = read_raw_json(spark, raw_path, schema, multiline=multiline)
    if not has_rows(raw):
        return 0
    fmt = format_catalogue_a if source == "a" else format_catalogue_b
    return sinks.write_counted(fmt(raw), lambda df: sinks.write_partition(df, silver_root, dt, files),
                               {"written": F.count(F.lit(1))})["written"]


def libraries_job(spark: SparkSession, library_dir: str, out_dir: str, checkpoint_dir: str,
                  max_items: int | None = None) -> dict:
    """O3: drain new library files into the consolidated table; batches, records read and rejected."""
    return consolidate_libraries(spark, library_dir, out_dir, checkpoint_dir, max_items)


def combine_job(spark: SparkSession, silver_a: str, silver_b: str, libraries: str, master_table: str,
                interactions_path: str, max_items: int | None = None, k: int = 10, max_tag_freq: int | None = None,
                as_of: str | None = None) -> dict:
    """O4-O6 + K5/K6 + K4: master catalogue (upserted) and interactions."""
    a = as_of_filter(read_silver(spark, silver_a, CATALOGUE_A_SILVER_SCHEMA), "dt", as_of)
    b = as_of_filter(read_silver(spark, silver_b), "dt", as_of)
    libs = read_silver(spark, libraries)
    # a user crawled twice keeps the latest capture (the stream never re-reads a file)
    libs = dedupe(libs, ["steam_id"], [F.col("scraped_at").desc_nulls_last()])
    rows = eng.explode_libraries(eng.valid_libraries(libs, max_items=max_items))
    rows = materialize(rows.withColumn("playtime_forever", F.col("playtime_forever").cast("double"))
                       .withColumn("playtime_2weeks", F.col("playtime_2weeks").cast("double")))
    stats = eng.item_stats(eng.positive(rows, "playtime_forever"))
    master = materialize(compute_similar_games(master_catalogue(a, b, stats), k=k, max_tag_freq=max_tag_freq))
    interactions = eng.enrich(eng.score_interactions(rows), master, "steam_appid", TAG_COLS,
                              order_by=[F.col("igdb_id")], union=TAG_COLS)
    refused = keyed.upsert_keyed(master, master_table, ["igdb_id"])
    written = sinks.write_counted(interactions, lambda df: sinks.write_gold(df, interactions_path),
                                  {"interactions": F.count(F.lit(1))})
    return {"master": keyed.read_keyed(spark, master_table).count(), "refused": refused.count(), **written}


def train_job(spark: SparkSession, interactions_path: str, out_path: str, k: int = 30, seed: int = 42,
              min_df: int = 5, min_users: int = 150, min_share: float = 0.15, min_score: float = 10.0,
              max_share: float = 0.20, per_cohort: int = 30, per_user: int = 10,
              libraries: str | None = None) -> dict:
    """O7-O9 + K4: learned cohorts, names, top-N unseen items per user.

    ``libraries`` (optional) supplies ownership from full libraries, so an
    owned but never-played item is not recommended either.
    """
    inter = read_gold(spark, interactions_path)
    if not has_rows(inter):
        return {"users": 0}
    counts = materialize(feat.user_tag_counts(inter, "steam_id", TAG_COLS))
    arrays = feat.user_tag_arrays(counts, inter)
    assign, pred = feat.assign_cohorts(arrays, "steam_id", k=k, seed=seed, min_df=min_df)
    assign = materialize(assign)
    silhouette = feat.cohort_quality(pred)
    labelled = materialize(coh.cohort_profile(counts.select("steam_id", "tag"), assign, n_cohorts=k,
                                              min_users=min_users, min_share=min_share))
    owned = None
    if libraries:
        owned = eng.explode_libraries(read_silver(spark, libraries)).select("steam_id", "steam_appid")
    ranked = rec.recommend(inter, labelled, owned, min_score=min_score, max_share=max_share,
                           per_cohort=per_cohort, per_user=per_user, n_cohorts=k)
    written = sinks.write_counted(rec.pack_recommendations(ranked), lambda df: sinks.write_gold(df, out_path),
                                  {"users": F.count(F.lit(1))})
    return {**written, "silhouette": silhouette}


def serve_jobs(spark: SparkSession, master_table: str, recommendations: str, catalogue_index: str,
               recommendation_index: str) -> dict:
    """Catalogue documents upserted, recommendation documents replaced."""
    out = {}
    master = keyed.read_keyed(spark, master_table)
    if has_rows(master):
        keyed.serve_upsert(master, "igdb_id", catalogue_index)
        out["catalogue_docs"] = keyed.read_keyed(spark, catalogue_index).count()
    recs = read_gold(spark, recommendations)
    if has_rows(recs):
        keyed.serve_replace(recs, "steam_id", recommendation_index)
        out["recommendation_docs"] = spark.read.parquet(recommendation_index).count()
    return out
