"""Libraries, engagement statistics and interaction scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions.scalar import affinity
from playlens.operators.joins import left_join_nonnull_keys
from playlens.operators.topk import dedupe


def library_ok(user: str = "steam_id", items: str = "games",
               max_items: int | None = None, min_items: int = 1) -> Column:
    """Whether a library has a user id and ``min_items <= size(items) <= max_items``."""
    n = F.size(F.col(items))
    return (F.col(user).isNotNull() & F.col(items).isNotNull()
            & (n >= min_items) & (F.lit(True) if max_items is None else n <= max_items))


def valid_libraries(libs: DataFrame, user: str = "steam_id", items: str = "games",
                    max_items: int | None = None, min_items: int = 1) -> DataFrame:
    """Libraries for which ``library_ok`` holds.

    Works on batch and streaming frames (stateless filter).
    """
    return libs.filter(library_ok(user, items, max_items, min_items))


def explode_libraries(libs: DataFrame, user: str = "steam_id", items: str = "games",
                      fields: Mapping[str, str] | None = None) -> DataFrame:
    """One row per (user, library element); empty or NULL lists give no rows."""
    fields = fields or {"steam_appid": "appid", "game_name": "name",
                        "playtime_forever": "playtime_forever",
                        "playtime_2weeks": "playtime_2weeks"}
    flat = libs.select(F.col(user), F.explode(F.col(items)).alias("_g"))
    return flat.select(F.col(user), *[F.col(f"_g.{src}").alias(dst) for dst, src in fields.items()])


def library_sizes(rows: DataFrame, user: str) -> DataFrame:
    """Items per user from flat rows (partial aggregation, no list built)."""
    return rows.groupBy(user).agg(F.count(F.lit(1)).alias("n_items"))


def capped_library_rows(rows: DataFrame, user: str, max_items: int | None = None,
                        min_items: int = 1) -> DataFrame:
    """Flat library rows of users whose library size is within bounds.

    Same result as building each list, filtering on ``size`` and exploding,
    (``max_items=None``: no upper bound) but computed as a count per user plus a semi-join, so no list is ever
    materialised and a user with a huge history never lands in one task.
    """
    ok = (library_sizes(rows, user)
          .filter((F.col("n_items") >= min_items) & (F.lit(True) if max_items is None else F.col("n_items") <= max_items))
          .select(user))
    return rows.join(ok, user, "left_semi")


def library_envelope(rows: DataFrame, user: str, element_cols: Sequence[str],
                     order_col: str, max_items: int | None = None,
                     captured_at: Column | None = None) -> DataFrame:
    """Nested library per user: ``(user, captured_at, games array<struct>)``.

    ``max_items`` leaves out larger libraries (None: keeps all; a list then has
    one element per item of its user); elements are sorted by ``order_col``.
    """
    kept = capped_library_rows(rows, user, max_items=max_items)
    elem = F.struct(*[F.col(c) for c in element_cols])
    out = kept.groupBy(user).agg(F.sort_array(F.collect_list(
        F.struct(F.col(order_col).alias("_k"), elem.alias("_e")))).alias("_l"))
    out = out.select(F.col(user), F.transform("_l", lambda x: x["_e"]).alias("games"))
    if captured_at is not None:
        out = out.withColumn("captured_at", captured_at)
    return out


def library_chunks(rows: DataFrame, user: str, element_cols: Sequence[str], order_cols: Sequence[str],
                   size: int = 500, max_items: int | None = None, min_items: int = 1) -> DataFrame:
    """G5 for libraries of any size: ``(user, chunk, first, n_games, games)``.

    A user's elements are numbered from 0 in the order of ``order_cols`` (a total
    order within the user) and cut into chunks of ``size``; ``first`` is the
    number of a chunk's first element.  No list is longer than ``size`` and no
    task holds a whole library: rows are dealt into sorted ranges and written
    once, each range numbers its own rows of a user, and the ranges'
    counts give the number to start from.  Libraries of more than ``max_items``
    or fewer than ``min_items`` elements are left out by their counts.  Rows
    with a NULL user are a library of their own.
    """
    from pyspark.sql import Window

    from playlens.session import materialize

    kept = rows.select(user, F.struct(*order_cols).alias("_k"), F.struct(*element_cols).alias("_e"))
    ranged = materialize(kept.repartitionByRange(user, "_k").withColumn("_range", F.spark_partition_id()), "library-ranges")
    sizes = ranged.groupBy(F.col(user).alias("_u"), F.col("_range").alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per user and range that the user's rows touch
    before = F.sum("_n").over(Window.partitionBy("_u").orderBy("_r"))
    total = F.sum("_n").over(Window.partitionBy("_u"))
    starts = sizes.select("_u", "_r", (before - F.col("_n")).alias("_before"), total.alias("_total")).where(
        (F.col("_total") >= min_items) & (F.lit(True) if max_items is None else F.col("_total") <= max_items))
    place = F.row_number().over(Window.partitionBy("_range", user).orderBy("_k"))
    numbered = (ranged.withColumn("_i", place)
                .join(starts, (F.col("_range") == F.col("_r")) & F.col(user).eqNullSafe(F.col("_u")))
                .withColumn("_i", F.col("_before") + F.col("_i") - 1)
                .withColumn("chunk", F.floor(F.col("_i") / size)))
    return (numbered.groupBy(user, "chunk").agg(F.sort_array(F.collect_list(F.struct("_i", "_e"))).alias("_l"))
            .select(user, "chunk", (F.col("chunk") * size).alias("first"), F.size("_l").alias("n_games"),
                    F.transform("_l", lambda x: x["_e"]).alias("games")))


def positive(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) > 0)


def with_group_avg(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Attach ``avg(value)`` of the row's ``key`` group to every row.

    Written as aggregate + join rather than an unordered window: the
    aggregate combines map-side, and the join back is a shuffle join that
    AQE can broadcast (small key table) or split (hot key), where a window
    would put a hot key's rows into one task.
    """
    stats = df.groupBy(key).agg(F.avg(value).alias(out))
    return df.join(stats, key, "left")


def score_interactions(rows: DataFrame, item: str = "steam_appid",
                       playtime: str = "playtime_forever") -> DataFrame:
    """O4 core: keep positive playtime, attach the item average, affinity."""
    active = positive(rows, playtime)
    scored = with_group_avg(active, item, playtime, "global_avg_playtime")
    return scored.withColumn("implicit_preference_score",
                             affinity(F.col(playtime), F.col("global_avg_playtime")))


def one_row_per_key(items: DataFrame, key: str, order_by) -> DataFrame:
    """Catalogue view with a single row per ``key`` (deterministic survivor)."""
    return dedupe(items.filter(F.col(key).isNotNull()), [key], order_by)


def merged_per_key(items: DataFrame, key: str, union: Sequence[str], order_by) -> DataFrame:
    """As ``one_row_per_key``, but the array columns ``union`` hold the elements
    of all rows of the key, each once and sorted (a single row's as they are).
    """
    def merged(c: str) -> Column:
        every = F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
        return F.when(F.count(c) > 1, every).otherwise(F.max(c)).alias(c)

    rows = items.filter(F.col(key).isNotNull())
    lists = rows.groupBy(F.col(key).alias("_mk")).agg(*[merged(c) for c in union])
    one = one_row_per_key(rows, key, order_by).drop(*union)
    return one.join(lists, one[key] == lists["_mk"]).drop("_mk")


def enrich(interactions: DataFrame, items: DataFrame, key: str, cols: Sequence[str],
           items_key: str | None = None, order_by=None, allow_fanout: bool = False,
           union: Sequence[str] = ()) -> DataFrame:
    """Left-join item attributes onto interactions by ``key``.

    The catalogue key need not be unique; unless ``allow_fanout`` the
    catalogue is first reduced to one row per key, so an interaction is never
    duplicated (which would inflate every later sum and count); of the array
    columns ``union`` that row has the elements of all rows of the key.
    """
    items_key = items_key or key
    if not allow_fanout:
        order_by = order_by or [F.col(c) for c in dict.fromkeys([items_key, *cols])]
        items = (merged_per_key(items, items_key, union, order_by) if union
                 else one_row_per_key(items, items_key, order_by))
    view = items.select(F.col(items_key).alias("_k"), *cols)
    return interactions.join(view, interactions[key] == view["_k"], "left").drop("_k")


def item_stats(interactions: DataFrame, item: str = "steam_appid",
               playtime: str = "playtime_forever", recent: str = "playtime_2weeks",
               prefix: str = "steam_") -> DataFrame:
    """A3: players, total and recent playtime (NULL recent counts as 0), average."""
    return interactions.groupBy(item).agg(
        F.count(F.lit(1)).alias(f"{prefix}player_count"),
        F.sum(playtime).alias(f"{prefix}total_playtime_forever"),
        F.sum(F.coalesce(F.col(recent).cast("double"), F.lit(0.0))).alias(f"{prefix}total_playtime_2weeks"),
        F.avg(playtime).alias(f"{prefix}avg_playtime"),
    )


STAT_DEFAULTS = {
    "steam_player_count": 0,
    "steam_total_playtime_forever": 0.0,
    "steam_total_playtime_2weeks": 0.0,
    "steam_avg_playtime": 0.0,
}


def attach_stats(items: DataFrame, stats: DataFrame, items_key: str, stats_key: str,
                 defaults: Mapping[str, object] = STAT_DEFAULTS) -> DataFrame:
    """J3 + P7: left-join per-item stats and fill missing stats with defaults.

    Items without a key (no store id) skip the shuffle join.
    """
    s = stats.withColumnRenamed(stats_key, "_sk")
    out = left_join_nonnull_keys(items, s, [items_key], ["_sk"]).drop("_sk")
    present = {k: v for k, v in defaults.items() if k in out.columns}
    return out.na.fill(present) if present else out
