"""Profile cohorts by tag lift and name them after their top tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions.scalar import lift
from playlens.operators.joins import broadcast_if_bounded
from playlens.operators.topk import top_k

# Tags never used to name a cohort, and the pattern of
# technical/platform tags excluded the same way (matched anywhere in the
# tag, case-insensitive).  Both must equal the reference's lists.
STOP_TAGS = [
    "open_world", "steam_trading_cards", "singleplayer", "multiplayer",
    "indie", "action", "steam_achievements", "free_to_play", "adventure",
    "simulator", "simulation", "strategy", "rpg", "co_op", "casual",
    "steam", "party", "early_access", "atmospheric", "2d", "3d",
]
STOP_PATTERN = ("(?i)controller|support|steam|remote|play|share|schermo|partida|partage"
                "|screen|speech|text|lang|audio|achievements")
UNKNOWN_COHORT = "Unknown Cluster"


def cohort_sizes(assignments: DataFrame, cohort: str = "cohort_id") -> DataFrame:
    """A10: users per cohort."""
    return assignments.groupBy(cohort).agg(F.count(F.lit(1)).alias("cohort_size"))


def tag_lift(user_tags: DataFrame, assignments: DataFrame, user: str = "steam_id",
             cohort: str = "cohort_id", n_cohorts: int | None = None) -> DataFrame:
    """A9-A11, J7, J8, X11 per (cohort, tag)::

        cohort_tag_users, cohort_size, cohort_prop = cohort_tag_users / cohort_size,
        global_tag_users, global_prop = global_tag_users / total_users,
        lift = cohort_prop / global_prop

    ``user_tags`` is ``(user, tag)``; it is made distinct once, so every
    count below is a count of distinct users.  ``assignments`` holds one row
    per user.  ``n_cohorts`` (when known, e.g. K) bounds the cohort-size
    table for broadcasting.
    """
    ut = user_tags.select(user, "tag").distinct()
    a = assignments.select(user, cohort)
    total = a.agg(F.count(F.lit(1))).scalar()
    per_cohort = ut.join(a, user).groupBy(cohort, "tag").agg(F.count(F.lit(1)).alias("cohort_tag_users"))
    # every user is in exactly one cohort, so a tag's users are the sum of its
    # per-cohort users: a window over the (cohort, tag) table, where a tag has
    # at most one row per cohort, instead of a second pass over the users
    per_tag = Window.partitionBy("tag")
    with_global = (per_cohort.withColumn("global_tag_users", F.sum("cohort_tag_users").over(per_tag))
                   .withColumn("global_prop", F.col("global_tag_users") / total))
    sizes = broadcast_if_bounded(cohort_sizes(a, cohort), n_cohorts)
    return (with_global.join(sizes, cohort)
            .withColumn("cohort_prop", F.col("cohort_tag_users") / F.col("cohort_size"))
            .withColumn("lift", lift(F.col("cohort_prop"), F.col("global_prop"))))


def cohort_names(lifts: DataFrame, cohort: str = "cohort_id", min_users: int = 150,
                 min_share: float = 0.15, stop_tags: Sequence[str] = tuple(STOP_TAGS),
                 stop_pattern: str | None = STOP_PATTERN, top_n: int = 2) -> DataFrame:
    """``(cohort, cohort_name)`` for cohorts with a qualifying tag.

    Tags need ``global_tag_users >= min_users`` and ``cohort_prop >= min_share``
    and must not be stop tags; the ``top_n`` by lift (then share, then tag)
    form ``"Cluster <id> (<t1> & <t2> Fans)"``.
    """
    cond = (F.col("global_tag_users") >= min_users) & (F.col("cohort_prop") >= min_share)
    if stop_tags:
        cond = cond & ~F.col("tag").isin(list(stop_tags))
    if stop_pattern:
        cond = cond & ~F.col("tag").rlike(stop_pattern)
    best = top_k(lifts.filter(cond), cohort,
                 [F.col("lift").desc(), F.col("cohort_prop").desc(), F.col("tag").asc()], top_n)
    named = best.groupBy(cohort).agg(F.sort_array(F.collect_list(F.struct("rank", "tag"))).alias("_t"))
    label = F.array_join(F.transform("_t", lambda x: x["tag"]), " & ")
    return named.select(cohort, F.concat(F.lit("Cluster "), F.col(cohort).cast("string"), F.lit(" ("),
                                         label, F.lit(" Fans)")).alias("cohort_name"))


def label_users(assignments: DataFrame, names: DataFrame, cohort: str = "cohort_id",
                n_cohorts: int | None = None) -> DataFrame:
    """Attach cohort names; cohorts without one get ``Unknown Cluster``."""
    return (assignments.join(broadcast_if_bounded(names, n_cohorts), cohort, "left")
            .na.fill({"cohort_name": UNKNOWN_COHORT}))


def cohort_profile(user_tags: DataFrame, assignments: DataFrame, user: str = "steam_id",
                   cohort: str = "cohort_id", n_cohorts: int | None = None, **naming) -> DataFrame:
    """Whole O8: labelled users ``(user, cohort, cohort_name)``."""
    lifts = tag_lift(user_tags, assignments, user, cohort, n_cohorts)
    names = cohort_names(lifts, cohort, **naming)
    return label_users(assignments.select(user, cohort), names, cohort, n_cohorts)
