"""Top-N unseen items per user from their cohort's favourites."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions.scalar import cohort_item_score
from playlens.operators.joins import broadcast_if_bounded
from playlens.operators.topk import top_k


def item_popularity(interactions: DataFrame, user: str = "steam_id", item: str = "steam_appid",
                    score: str = "implicit_preference_score") -> DataFrame:
    """``(item, user_count, global_score)``; users counted once per item.

    Two aggregation levels, both combined map-side: per (item, user), then
    per item.
    """
    per_pair = interactions.groupBy(item, user).agg(F.sum(score).alias("_s"))
    return per_pair.groupBy(item).agg(F.count(F.lit(1)).alias("user_count"),
                                      F.sum("_s").alias("global_score"))


def not_ubiquitous(popularity: DataFrame, total_users, max_share: float = 0.20) -> DataFrame:
    """items held by strictly fewer than ``max_share`` of all users."""
    return popularity.filter(F.col("user_count") < F.lit(max_share) * total_users)


def total_users(interactions: DataFrame, user: str = "steam_id"):
    """Distinct users, as a scalar subquery column (no driver round trip)."""
    return interactions.select(user).distinct().agg(F.count(F.lit(1))).scalar()


def item_names(interactions: DataFrame, item: str = "steam_appid", name: str = "game_name") -> DataFrame:
    """``(item, item_name)``: one name per item id (the greatest, so a
    renamed item keeps a single, deterministic name).

    Distinct (item, name) pairs are reduced first with a hash aggregate, so
    the string ``max`` only sees a handful of rows per item.
    """
    return (interactions.select(item, name).distinct()
            .groupBy(item).agg(F.max(name).alias("item_name")))


def attach_item_names(top: DataFrame, interactions: DataFrame, item: str = "steam_appid",
                      name: str = "game_name", bound: int | None = None) -> DataFrame:
    """Left-join ``item_name`` onto a small ranked table.

    Names are looked up only for the items in ``top`` (a semi-join, broadcast
    when ``bound`` proves the table small), so the lookup never shuffles the
    whole interaction table.
    """
    wanted = broadcast_if_bounded(top.select(item).distinct(), bound)
    names = item_names(interactions.join(wanted, item, "left_semi"), item, name)
    return top.join(names, item, "left")


def cohort_scores(interactions: DataFrame, labelled: DataFrame, user: str = "steam_id",
                  item: str = "steam_appid", name: str = "game_name",
                  score: str = "implicit_preference_score", cohort: str = "cohort_id",
                  min_score: float = 10.0, max_share: float = 0.20,
                  exponent: float = 1.2, with_names: bool = True, unique_pairs: bool = False,
                  repeated_labels: bool = False) -> DataFrame:
    """J10, A13-A15, F10, F11, J11, X9 per (cohort, item)::

        cohort_score = sum of affinity of the cohort's users
        game_cluster_score = pow(cohort_score, exponent) / log1p(global_score)

    Grouped by item id only, so a renamed item is never split; the
    aggregation is all-numeric (hash aggregate) and names are attached
    afterwards (``with_names``).  Keeps ``cohort_score > min_score`` and items
    that are not ubiquitous.

    A user is in one cohort at most, so an item's users and score are the sums
    over its cohorts (users without a cohort form one more): interactions are
    aggregated once, and the window holds one row per cohort of an item.
    ``unique_pairs`` says that a user has at most one interaction with an item;
    otherwise a user's interactions with an item are added up first.  With it,
    ``repeated_labels`` adds up a label's rows that stand more than once the same way: they
    count a score so many times and a user once.
    """
    inter = interactions.select(user, item, score)
    labels = labelled.select(user, cohort)
    if unique_pairs and repeated_labels:
        times = labels.groupBy(user, cohort).agg(F.count(F.lit(1)).alias("_times"))
        joined = inter.join(times, user, "left").withColumn(score, F.col(score) * F.coalesce("_times", F.lit(1)))
    else:
        joined = inter.join(labels, user, "left")
    if not unique_pairs:
        joined = joined.groupBy(user, cohort, item).agg(F.sum(score).alias(score))
    per_cohort = joined.groupBy(cohort, item).agg(F.sum(score).alias("cohort_score"), F.count(F.lit(1)).alias("_u"))
    per_item = Window.partitionBy(item)
    pop = (per_cohort.withColumn("user_count", F.sum("_u").over(per_item))
           .withColumn("global_score", F.sum("cohort_score").over(per_item)).drop("_u"))
    out = (not_ubiquitous(pop, total_users(inter, user), max_share)
           .filter(F.col(cohort).isNotNull() & (F.col("cohort_score") > min_score))
           .withColumn("game_cluster_score",
                       cohort_item_score(F.col("cohort_score"), F.col("global_score"), exponent)))
    if with_names:
        out = out.join(item_names(interactions, item, name), item, "left")
    return out


def cohort_top_items(scores: DataFrame, item: str = "steam_appid", cohort: str = "cohort_id",
                     n: int = 30) -> DataFrame:
    """Best ``n`` items per cohort (score desc, then item id)."""
    return top_k(scores, cohort, [F.col("game_cluster_score").desc_nulls_last(), F.col(item).asc()],
                 n, rank_col="cohort_rank")


def recommend(interactions: DataFrame, labelled: DataFrame, owned: DataFrame | None = None,
              user: str = "steam_id", item: str = "steam_appid", name: str = "game_name",
              score: str = "implicit_preference_score", cohort: str = "cohort_id",
              min_score: float = 10.0, max_share: float = 0.20, exponent: float = 1.2,
              per_cohort: int = 30, per_user: int = 10, n_cohorts: int | None = None,
              assignments: DataFrame | None = None, unique_pairs: bool = False) -> DataFrame:
    """Whole O9 before packing: ``(user, cohort, cohort_name, reco_rank, item,
    item_name, game_cluster_score)``.

    ``labelled`` is ``(user, cohort, cohort_name)``.  ``owned`` is the
    ``(user, item)`` ownership frame (default: the interactions).  The
    candidate table has at most ``n_cohorts * per_cohort`` rows; it is
    broadcast when that bound fits (``n_cohorts`` is counted when not
    given), so the fan-out to users never shuffles users onto a handful of
    cohort keys; beyond the bound it stays a shuffle join on many keys.
    ``assignments`` (``(user, cohort)``, optional) is used for scoring, so
    the labelled table (which carries names) is read only once.
    """
    scores = cohort_scores(interactions, assignments if assignments is not None else labelled, user, item,
                           name, score, cohort, min_score, max_share, exponent, with_names=False, unique_pairs=unique_pairs)
    top = cohort_top_items(scores, item, cohort, per_cohort).select(cohort, item, "game_cluster_score")
    if n_cohorts is None:
        # measure the bound (a map-side-combined distinct count): with few
        # cohorts the fan-out must not shuffle users onto a handful of keys;
        # with very many, the shuffle join on cohort spreads well by itself
        n_cohorts = labelled.select(cohort).distinct().count()
    bound = n_cohorts * per_cohort
    top = attach_item_names(top, interactions, item, name, bound)
    cand = labelled.select(user, cohort, "cohort_name").join(broadcast_if_bounded(top, bound), cohort)
    # only ownership of candidate items can exclude anything
    own = ((owned if owned is not None else interactions).select(user, item)
           .join(broadcast_if_bounded(top.select(item).distinct(), bound), item, "left_semi"))
    fresh = cand.join(own, [user, item], "left_anti")
    return top_k(fresh, user, [F.col("game_cluster_score").desc_nulls_last(), F.col(item).asc()],
                 per_user, rank_col="reco_rank")


def pack_recommendations(ranked: DataFrame, user: str = "steam_id", item: str = "steam_appid",
                         cohort: str = "cohort_id") -> DataFrame:
    """Parallel lists per user in rank order (names, rounded scores, ids).

    The lists are built from one collected struct per row, so names and
    scores stay aligned even when a name is NULL.
    """
    lst = ranked.groupBy(user, cohort, "cohort_name").agg(F.sort_array(F.collect_list(F.struct(
        "reco_rank", item, "item_name", F.round("game_cluster_score", 2).alias("s")))).alias("_l"))
    return lst.select(
        user, cohort, "cohort_name",
        F.transform("_l", lambda x: x["item_name"]).alias("recommended_games"),
        F.transform("_l", lambda x: x["s"]).alias("recommendation_scores"),
        F.transform("_l", lambda x: x[item]).alias("recommended_ids"))
