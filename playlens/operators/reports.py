"""Report queries over the gold outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.operators.topk import top_k


def report_cohort_sizes(labelled: DataFrame, cohort: str = "cohort_id") -> DataFrame:
    """Users per cohort and its name."""
    return labelled.groupBy(cohort, "cohort_name").agg(F.count(F.lit(1)).alias("n_users"))


def report_top_items(ranked: DataFrame, cohort: str = "cohort_id", item: str = "steam_appid",
                     n: int = 5) -> DataFrame:
    """Items recommended to the most users of each cohort (top ``n``).

    ``ranked`` is the unpacked recommendation rows (one per user and item).
    """
    counts = ranked.groupBy(cohort, item).agg(F.count(F.lit(1)).alias("n_users"),
                                              F.max("item_name").alias("item_name"))
    return top_k(counts, cohort, [F.col("n_users").desc(), F.col(item).asc()], n, rank_col="rank")


def report_ratings(master: DataFrame) -> DataFrame:
    """Ratings of both catalogues side by side with their gap."""
    return master.select(
        "igdb_id", "igdb_name", "release_year",
        F.col("igdb_rating").cast("double").alias("igdb_rating"),
        F.col("rawg_rating").cast("double").alias("rawg_rating"),
        "rawg_metacritic", "steam_player_count",
        F.abs(F.col("igdb_rating").cast("double") / 20.0 - F.col("rawg_rating").cast("double"))
        .alias("rating_gap"))


def report_neighbour_overlap(catalogue: DataFrame, id_col: str = "igdb_id") -> DataFrame:
    """Editorial vs computed neighbours and how many they share."""
    return catalogue.select(
        id_col,
        F.size("similar_game_names").alias("n_editorial"),
        F.size("computed_similar_games").alias("n_computed"),
        F.size(F.array_intersect("similar_game_names", "computed_similar_games")).alias("n_shared"))


def preview(df: DataFrame, order_by, n: int = 5) -> DataFrame:
    """The first ``n`` rows under a total order (a bounded top-N)."""
    return df.orderBy(*order_by).limit(n)
