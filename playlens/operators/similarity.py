"""Items that share tags, scored by Jaccard overlap, top-k per item.

Plan shape (kept deliberately):

1. items with equal tag sets are one set: pairs are built between sets, and a
   set carries its first ``k + 1`` items only;
2. the sets nearest to each set come from the bounded set join of
   ``setjoin.py``: pairs are met through their rarest common tags and only
   at or above a threshold that falls until a set has ``k`` neighbours;
3. the best ``k + 1`` sets are kept per set with ``row_number``
   (``WindowGroupLimit`` runs before the exchange);
4. the sets' first items give each set its best ``k + 1`` items, and every
   item takes that list without itself.

Only ``k + 1`` sets and items are needed: what ranks behind ``k + 1`` sets has
an item of each of them before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions.scalar import jaccard, unify_tags
from playlens.operators.setjoin import rarity_codes, top_sets
from playlens.operators.topk import top_k
from playlens.session import materialize


def item_tag_rows(items: DataFrame, id_col: str, name_col: str,
                  tag_cols: Sequence[str]) -> DataFrame:
    """``(id, name, n_tags, tag)``: one row per distinct tag of an item.

    ``n_tags`` is the size of the unified tag set; an item without tags
    yields no rows.
    """
    tagged = items.select(F.col(id_col).alias("id"), F.col(name_col).alias("name"),
                          unify_tags(*tag_cols).alias("tags"))
    return tagged.select("id", "name", F.size("tags").alias("n_tags"),
                         F.explode("tags").alias("tag"))


def tag_frequency(rows: DataFrame) -> DataFrame:
    """A4: number of items carrying each tag."""
    return rows.groupBy("tag").agg(F.count(F.lit(1)).alias("n_items"))


def drop_frequent_tags(rows: DataFrame, max_tag_freq: int | None) -> DataFrame:
    """Remove rows whose tag is carried by more than ``max_tag_freq`` items
    (None: no limit)."""
    if max_tag_freq is None:
        return rows
    frequent = tag_frequency(rows).filter(F.col("n_items") > max_tag_freq).select("tag")
    return rows.join(frequent, "tag", "left_anti")


def name_order(meta: DataFrame) -> DataFrame:
    """``(name, name_ord)``: a long that sorts like the name (NULL first).

    Distinct names are range-partitioned and sorted; the partition index and
    the row offset inside the sorted partition (``monotonically_increasing_id``)
    then increase with the name, so the key preserves the order without a
    single-partition ``rank()``.
    """
    return (meta.select("name").distinct().orderBy(F.col("name").asc_nulls_first())
            .withColumn("name_ord", F.monotonically_increasing_id()))


def tag_similarity(items: DataFrame, id_col: str = "igdb_id", name_col: str = "igdb_name",
                   tag_cols: Sequence[str] = ("genre_names", "theme_names", "tag_names"),
                   k: int = 10, max_tag_freq: int | None = None, size_basis: str = "all",
                   partitions: int | None = None) -> DataFrame:
    """Top-``k`` neighbours per item: ``(id, rank, nbr_id, nbr_name, shared, score)``.

    ``shared`` counts tags the two items have in common, ignoring tags above
    ``max_tag_freq``.  ``size_basis="all"`` divides by the full tag-set sizes
    (the reference formula), ``"kept"`` by the sizes after dropping frequent
    tags (a true Jaccard on kept tags).  Pairs are keyed by item id, so two
    items with the same name stay distinct.  Order: score desc, neighbour
    name asc (NULL first), neighbour id asc.

    Only numbers travel with the pairs (ids, counts, a score); names are carried
    by the first items of each set.  The per-item table with the
    order key is written once to the checkpoint folder, so all readers agree
    on the keys.  ``partitions`` (default ``spark.sql.shuffle.partitions``) is
    the width of the pair join, also where one side is broadcast.
    """
    if size_basis not in ("all", "kept"):
        raise ValueError("size_basis must be 'all' or 'kept'")
    rows = item_tag_rows(items, id_col, name_col, tag_cols)
    kept = drop_frequent_tags(rows, max_tag_freq).filter(F.col("tag").isNotNull())
    # an item's own tags: a list no longer than the item's record
    per_item = kept.groupBy("id", "name", "n_tags").agg(F.sort_array(F.collect_set("tag")).alias("tags"))
    if size_basis == "kept":
        per_item = per_item.withColumn("n_tags", F.size("tags"))
    order_keys = name_order(per_item)
    members = materialize(per_item.join(order_keys, per_item["name"].eqNullSafe(order_keys["name"]))
                          .drop(order_keys["name"]), "item-order")

    in_set = ["tags", "n_tags"]
    order = [F.col("name_ord").asc(), F.col("id").asc()]
    heads = top_k(members, in_set, order, k + 1, rank_col="pos")
    heads = materialize(heads.withColumn("sid", F.first("id").over(Window.partitionBy(*in_set).orderBy(*order))), "sets")
    firsts = heads.filter("pos = 1")

    sets = rarity_codes(firsts.select("sid", F.explode("tags").alias("tag")), "sid", "tag").join(
        firsts.select("sid", F.col("n_tags").alias("n")), "sid")
    # k other sets beside the set itself
    pairs = top_sets(materialize(sets, "coded-sets"), k, partitions=partitions)
    orders = firsts.select(F.col("sid").alias("nbr_sid"), F.col("name_ord").alias("nbr_o"))
    both = pairs.join(orders, "nbr_sid").select("sid", "nbr_sid", "nbr_o", "shared", "score")
    n_own = F.size("tags").cast("long")
    own = firsts.select("sid", F.col("sid").alias("nbr_sid"), F.col("name_ord").alias("nbr_o"), n_own.alias("shared"),
                        jaccard(n_own, F.col("n_tags"), F.col("n_tags")).alias("score"))
    best = [F.col("score").desc_nulls_last(), F.col("nbr_o").asc()]
    near = top_k(both.unionByName(own), "sid", [*best, F.col("nbr_sid").asc()], k + 1, rank_col=None)

    reps = heads.select(F.col("sid").alias("nbr_sid"), F.col("id").alias("nbr_id"), F.col("name").alias("nbr_name"),
                        F.col("name_ord").alias("item_o"))
    cand = near.drop("nbr_o").join(reps, "nbr_sid").withColumnRenamed("item_o", "nbr_o")
    listed = top_k(cand, "sid", [*best, F.col("nbr_id").asc()], k + 1, rank_col="pos")
    lists = listed.groupBy("sid").agg(F.sort_array(F.collect_list(
        F.struct("pos", "nbr_id", "nbr_name", "shared", "score"))).alias("l"))   # k + 1 entries at most
    of_set = lists.join(firsts.select("sid", *in_set), "sid").drop("sid")
    others = F.filter("l", lambda x: x["nbr_id"] != F.col("id"))
    return (members.join(of_set, in_set)
            .select("id", F.posexplode(F.slice(others, 1, k)).alias("at", "x"))
            .select("id", (F.col("at") + 1).alias("rank"), "x.nbr_id", "x.nbr_name", "x.shared", "x.score"))


def neighbour_lists(top: DataFrame) -> DataFrame:
    """``(id, nbr_ids[], nbr_names[], nbr_scores[])`` in rank order.

    Each list holds at most k entries; order comes from the rank carried in
    the collected struct, not from any upstream sort.
    """
    lst = top.groupBy("id").agg(F.sort_array(F.collect_list(
        F.struct("rank", "nbr_id", "nbr_name", "score"))).alias("_l"))
    return lst.select(
        "id",
        F.transform("_l", lambda x: x["nbr_id"]).alias("nbr_ids"),
        F.transform("_l", lambda x: x["nbr_name"]).alias("nbr_names"),
        F.transform("_l", lambda x: x["score"]).alias("nbr_scores"))


def attach_neighbours(items: DataFrame, lists: DataFrame, id_col: str = "igdb_id",
                      editorial_col: str | None = "similar_game_names") -> DataFrame:
    """Left-join the lists; items without neighbours get empty arrays."""
    names = lists.select(F.col("id").alias("_nid"), F.col("nbr_names").alias("computed_similar_games"))
    out = items.join(names, items[id_col] == names["_nid"], "left").drop("_nid")
    out = out.withColumn("computed_similar_games", F.coalesce(
        F.col("computed_similar_games"), F.array().cast("array<string>")))
    if editorial_col and editorial_col in items.columns:
        out = out.withColumn(editorial_col, F.coalesce(
            F.col(editorial_col), F.array().cast("array<string>")))
    return out


def compute_similar_games(items: DataFrame, id_col: str = "igdb_id", name_col: str = "igdb_name",
                          tag_cols: Sequence[str] = ("genre_names", "theme_names", "tag_names"),
                          k: int = 10, max_tag_freq: int | None = None, size_basis: str = "all") -> DataFrame:
    """Whole O6: the catalogue with ``computed_similar_games`` attached."""
    top = tag_similarity(items, id_col, name_col, tag_cols, k, max_tag_freq, size_basis)
    return attach_neighbours(items, neighbour_lists(top), id_col)
