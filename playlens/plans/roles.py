"""How the driver's TPC-H-style tables play the catalogue/user roles.

item = ``part``; user = ``customer``; interaction = quantity bought per
(customer, part) (all of it as ``playtime_forever``, open lines as
``playtime_2weeks``); item tags = words of ``p_name`` + ``p_brand`` +
``p_type``; user profile tag = ``p_brand`` + ``p_type``; given cohort =
``c_mktsegment``.  Everything here is derived by Spark from the tables, so
each query's work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.operators.engagement import enrich, positive, score_interactions
from playlens.session import materialize

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Fixed parameters of the registered queries at the driver's scale factors.
TAG_CAP = 300            # item-tag frequency cap for tag similarity
TAG_CAP_WIDE = 1500      # the reference's own cap
NEIGHBOURS = 10
MIN_DF = 5
MIN_USERS = 100
MIN_SHARE = 0.15
MIN_SCORE = 1.0
MAX_SHARE = 0.20
PER_COHORT = 30
PER_USER = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def purchase_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, item_id, playtime_forever, playtime_2weeks)``, one row per
    (customer, part); ``playtime_2weeks`` is NULL when no line is open."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linestatus")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li["l_orderkey"] == o["o_orderkey"])
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
            .agg(F.sum("l_quantity").alias("playtime_forever"),
                 F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))).alias("playtime_2weeks")))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue view of ``part`` with tag arrays."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("item_name"),
        F.split("p_name", " ").alias("genre_names"),
        F.array("p_brand").alias("theme_names"),
        F.array("p_type").alias("tag_names"),
        F.array(F.concat_ws(" ", "p_brand", "p_type")).alias("profile_tags"))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4 on the driver tables: positive playtime, item average, affinity,
    item name and profile tags attached (one catalogue row per item)."""
    # the item average and the rows it is joined back to both read the
    # purchase rows: write them once instead of joining lineitem twice
    scored = score_interactions(materialize(purchase_rows(spark, sf_dir), "purchases"), item="item_id")
    return enrich(scored, items(spark, sf_dir), "item_id", ["item_name", "profile_tags"],
                  order_by=[F.col("item_id")])


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, cohort_id)`` of every customer."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("cohort_id"))


def given_cohorts(spark: SparkSession, sf_dir: str, inter: DataFrame | None = None) -> DataFrame:
    """``(user_id, cohort_id)`` for every user with interactions: the market segment."""
    inter = inter if inter is not None else interactions(spark, sf_dir)
    users = inter.select("user_id").distinct()
    return users.join(segments(spark, sf_dir), "user_id")


def n_given_cohorts(spark: SparkSession, sf_dir: str) -> int:
    """Distinct segments, counted on the customer table (bounds broadcasts)."""
    return (table(spark, sf_dir, "customer").select("c_mktsegment").distinct().count())


def positive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positive(purchase_rows(spark, sf_dir), "playtime_forever")
