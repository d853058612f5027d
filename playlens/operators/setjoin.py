"""Bounded top-k set join: the most similar sets of each set, without all pairs.

Thresholds fall from round to round.  A round finds every pair in which one
set is still open and the similarity reaches the round's threshold; a set that
has ``k`` similar sets by then is settled, since whatever was not found is
below the threshold.  The others go on to the next, lower threshold; the last
one, zero, admits every common element.  Open sets grow rare, so the wide
rounds are run for few of them.

Within a round, elements are ordered from rare to frequent.  Two sets that
reach similarity ``t`` share at least ``o = ceil(t n)`` elements, so their
first ``l`` common elements lie among the first ``m - o + l`` of each: those
``l`` elements together are the join key.  Small sets take keys of three
elements, larger ones of two or one, so a key is shared by few sets and a set
has few keys.  Sizes, the elements that remain and the exact overlap are
checked inside the join, where a pair counts at its first key alone: no
candidate is written twice and none needs to be made distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.session import materialize

#: Thresholds of the rounds; zero must end them.
ROUNDS = (0.8, 0.6, 0.4, 0.2, 0.0)
#: Largest size of a set whose keys have so many elements (one element: any size).
KEY_SIZES = {3: 8, 2: 24}
#: Sets of a key that one block of the join holds, about.
BLOCK = 1000


def rarity_codes(rows: DataFrame, id_col: str, tag_col: str) -> DataFrame:
    """``(id, tags)``: each id's distinct elements as numbers, rare ones first.

    Codes rise with frequency (ties by the element): frequencies are sorted by
    range, and the place in that order is the code."""
    each = rows.select(id_col, tag_col).distinct()
    counts = each.groupBy(tag_col).agg(F.count(F.lit(1)).alias("n"))
    codes = materialize(counts.orderBy("n", tag_col).select(tag_col, F.monotonically_increasing_id().alias("code")), "codes")
    return each.join(codes, tag_col).groupBy(id_col).agg(F.sort_array(F.collect_list("code")).alias("tags"))


def _overlap(t: float, n: Column) -> Column:
    """Least number of common elements at similarity ``t`` for a set of ``n``."""
    return F.greatest(F.ceil(F.lit(t) * n - F.lit(1e-9)).cast("int"), F.lit(1))


def _key_length(t: float, n: Column) -> Column:
    by_size = F.lit(1)
    for length, size in sorted(KEY_SIZES.items()):
        by_size = F.when(n <= size, F.lit(length)).otherwise(by_size)
    return F.least(by_size, _overlap(t, n))


def _keys(tags: Column, length: int) -> Column:
    """All choices of ``length`` elements, in order."""
    one = F.transform(tags, lambda x: F.array(x))
    for _ in range(length - 1):
        one = F.flatten(F.transform(one, lambda head: F.transform(
            F.filter(tags, lambda y: y > F.element_at(head, -1)), lambda y: F.concat(head, F.array(y)))))
    return one


def _indexed(sets: DataFrame, t: float, lengths: list[int], own_length: bool) -> DataFrame:
    """``(key, sid, n, o, tags)``: the keys of each set at threshold ``t``."""
    parts = []
    for length in lengths:
        some = sets.where(F.size("tags") >= length)
        if own_length:
            some = some.where(_key_length(t, F.col("n")) == length)
        elif length in KEY_SIZES and t > 0:
            some = some.where(F.col("n") <= F.lit(KEY_SIZES[length] / t + 1e-9))  # larger ones are no match
        least = _overlap(t, F.col("n"))
        front = F.size("tags") - F.greatest(least, F.lit(length)) + length
        parts.append(some.where(F.size("tags") >= least)
                     .withColumn("key", F.explode(_keys(F.slice("tags", 1, front), length))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _round(open_sets: DataFrame, sets: DataFrame, t: float, n_parts: int) -> DataFrame:
    """``(sid, nbr_sid, shared, score)`` of every open set with every other set at ``t`` or more."""
    lengths = sorted(r[0] for r in open_sets.select(_key_length(t, F.col("n")).alias("l")).distinct().collect())
    asking = _indexed(open_sets, t, lengths, True)
    asked = _indexed(sets, t, lengths, False)
    a = asking.select("key", "sid", "n", "tags")
    b = asked.select("key", F.col("sid").alias("nbr_sid"), F.col("n").alias("nbr_n"), F.col("tags").alias("nbr_tags"))
    # a key of very many sets is dealt into blocks, so that no task owns it
    large = materialize(a.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
                        .where("blocks > 1"), "large-keys")
    if large.isEmpty():
        a, b = a.withColumn("blk", F.lit(0)), b.withColumn("blk", F.lit(0))
    else:
        n_blocks = F.coalesce("blocks", F.lit(1))
        a = a.join(large, "key", "left").withColumn("blk", F.pmod(F.xxhash64("sid"), n_blocks).cast("int")).drop("blocks")
        b = b.join(large, "key", "left").withColumn("blk", F.explode(F.sequence(F.lit(0), n_blocks - 1))).drop("blocks")
    common = F.array_intersect("tags", "nbr_tags")
    fits = ((F.col("n") >= F.lit(t) * F.col("nbr_n") - F.lit(1e-9)) & (F.col("nbr_n") >= F.lit(t) * F.col("n") - F.lit(1e-9)))
    pairs = (a.repartition(n_parts, "key", "blk").join(b, ["key", "blk"])
             .where((F.col("sid") != F.col("nbr_sid")) & fits)
             .withColumn("common", common)
             .where(F.slice("common", 1, F.size("key")) == F.col("key"))
             .withColumn("shared", F.size("common").cast("long")))
    score = F.col("shared") / (F.col("n") + F.col("nbr_n") - F.col("shared"))
    return (pairs.select("sid", "nbr_sid", "shared", score.alias("score")).where(F.col("score") >= F.lit(t) - F.lit(1e-9)))


def top_sets(sets: DataFrame, k: int, rounds: tuple = ROUNDS, partitions: int | None = None) -> DataFrame:
    """``(sid, nbr_sid, shared, score)``: for each set, all pairs with other sets at
    the threshold of the round that settled it, so its ``k`` best and whatever ties with them.

    ``sets``: ``sid`` (unique), ``n`` (size that counts; at least the number of
    ``tags``) and ``tags`` (increasing codes, rare first).  Similarity is shared
    / (n + n' - shared).  A set with fewer than ``k`` others that share anything
    has all of them; an empty set has none; no sets give no rows."""
    spark = sets.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not rounds or rounds[-1] != 0:
        raise ValueError("the last threshold must be zero")
    sets = sets.select("sid", F.col("n").cast("int").alias("n"), "tags")
    sizes = [r[0] for r in sets.select("n").distinct().orderBy("n").collect()]  # no more than the largest set
    if not sizes:   # a cap may leave no element at all
        return sets.select("sid", F.col("sid").alias("nbr_sid"), F.lit(0).cast("long").alias("shared"), F.lit(0.0).alias("score"))
    # two different sets of one size share all but one element at most, of two sizes the smaller
    reach = max([(n - 1) / (n + 1) for n in sizes] + [m / n for m, n in zip(sizes, sizes[1:])], default=0.0)
    open_sets, found = sets, []
    for t in rounds:
        if t > reach + 1e-9:
            continue
        pairs = materialize(_round(open_sets, sets, t, n_parts), "near-sets")
        if t == 0:
            found.append(pairs)
            break
        settled = pairs.groupBy("sid").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") >= k).select("sid")
        found.append(pairs.join(settled, "sid", "left_semi"))
        open_sets = materialize(open_sets.join(settled, "sid", "left_anti"), "open-sets")
        if open_sets.isEmpty():
            break
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out
