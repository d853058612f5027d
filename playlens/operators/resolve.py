"""Version resolution, cross-catalogue linking, delta filters and paging."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions.scalar import link_key, release_year
from playlens.operators.engagement import attach_stats, STAT_DEFAULTS
from playlens.operators.joins import left_join_nonnull_keys
from playlens.operators.topk import dedupe, latest_per_key


def link_catalogues(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                    right_keys: Sequence[str], right_order) -> DataFrame:
    """Left-join ``right`` on a composite key after reducing it to one row
    per key (deterministic survivor under ``right_order``).

    Keys compare with ``=``, so a NULL key part never links; such rows skip
    the join (see ``left_join_nonnull_keys``).  Only the left key columns
    are kept in the output.
    """
    nonnull = F.lit(True)
    for k in right_keys:
        nonnull = nonnull & F.col(k).isNotNull()
    r = dedupe(right.filter(nonnull), list(right_keys), right_order)
    out = left_join_nonnull_keys(left, r, left_keys, right_keys)
    return out.drop(*[k for k in right_keys if k not in left_keys])


def changed_since(df: DataFrame, ts_col: str, as_of, days: int = 1,
                  min_col: str | None = None, min_value: float | None = None) -> DataFrame:
    """Rows updated strictly after ``as_of - days`` (and ``min_col > min_value``)."""
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    elif isinstance(as_of, date) and not isinstance(as_of, datetime):
        as_of = datetime(as_of.year, as_of.month, as_of.day)
    cond = F.col(ts_col) > F.lit(as_of - timedelta(days=days)).cast(df.schema[ts_col].dataType.simpleString())
    if min_col is not None:
        cond = cond & (F.col(min_col) > F.lit(min_value))
    return df.filter(cond)


def changed_between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows with ``lo <= col <= hi`` (closed range, e.g. ``[date-1, date]``)."""
    return df.filter(F.col(col).between(F.lit(lo), F.lit(hi)))


def eligible(df: DataFrame, type_col: str, types: Sequence, arr_col: str,
             pred) -> DataFrame:
    """``type_col`` in ``types`` and some element of ``arr_col`` matches ``pred``."""
    return df.filter(F.col(type_col).isin(list(types)) & F.exists(F.col(arr_col), pred))


def page(df: DataFrame, order_by, limit: int, offset: int = 0) -> DataFrame:
    """One page of a totally ordered frame (``ORDER BY ... OFFSET n LIMIT m``)."""
    ordered = df.orderBy(*order_by)
    if offset:
        ordered = ordered.offset(offset)
    return ordered.limit(limit)


def keyset_page(df: DataFrame, order: Sequence[tuple[str, bool]], limit: int,
                after: Sequence | None = None) -> tuple[DataFrame, tuple | None]:
    """L1/L2 by cursor: the ``limit`` rows behind ``after``, and the next cursor.

    ``order`` lists ``(column, descending)``, together a total order; NULLs come last.
    ``after`` is the sort key of the last row seen (None: the first page), and the
    next cursor that of the page's last row (None: nothing is left).  Rows up to
    the cursor are filtered out in the scan, then each task keeps its first
    ``limit`` rows: page 1000 costs what page 1 does, where an offset sorts all
    pages before it.
    """
    if after is not None:
        behind, equal = F.lit(False), F.lit(True)
        for (c, descending), v in zip(order, after):
            if v is not None:
                beyond = F.col(c) < F.lit(v) if descending else F.col(c) > F.lit(v)
                behind = behind | (equal & (beyond | F.col(c).isNull()))
            equal = equal & F.col(c).eqNullSafe(F.lit(v))
        df = df.filter(behind)
    sort = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c, descending in order]
    rows = df.orderBy(*sort).limit(limit)
    # the page's last row: the greatest of its at most ``limit`` rows
    back = [F.col(c).asc_nulls_first() if descending else F.col(c).desc_nulls_first() for c, descending in order]
    last = rows.select(*[c for c, _ in order]).orderBy(*back).limit(1).collect()
    return rows, tuple(last[0]) if last else None


RAWG_DEFAULTS = {
    "rawg_rating": 0.0,
    "rawg_metacritic": 0,
    "rawg_status_owned": 0,
    "rawg_status_beaten": 0,
    "rawg_status_dropped": 0,
}


def prepare_catalogue_a(a: DataFrame) -> DataFrame:
    return a.select(
        F.col("id").alias("igdb_id"), F.col("name").alias("igdb_name"),
        F.col("slug").alias("igdb_slug"), F.col("rating").alias("igdb_rating"),
        F.col("rating_count").alias("igdb_rating_count"), "similar_game_names", "steam_appid",
        "release_date", release_year("release_date").alias("release_year"),
        link_key("name").alias("norm_name"),
        "genre_names", "theme_names", "platform_names", "developers", "publishers")


def prepare_catalogue_b(b: DataFrame) -> DataFrame:
    return b.select(
        F.col("id").alias("rawg_id"), F.col("rating").alias("rawg_rating"),
        F.col("metacritic").alias("rawg_metacritic"),
        F.col("status_owned").alias("rawg_status_owned"),
        F.col("status_beaten").alias("rawg_status_beaten"),
        F.col("status_dropped").alias("rawg_status_dropped"),
        release_year("release_date").alias("rawg_release_year"),
        link_key("name").alias("rawg_norm_name"), "tag_names")


def master_catalogue(a_silver: DataFrame, b_silver: DataFrame, stats: DataFrame | None,
                     baseline_labels: Sequence[str] = ("initial",)) -> DataFrame:
    """Latest version of each catalogue, linked on (name key, year), with
    per-item engagement stats attached and defaults filled."""
    a = latest_per_key(a_silver, ["id"], "dt", baseline_labels,
                       tie_breaks=[F.col("updated_at").desc_nulls_last()])
    b = latest_per_key(b_silver, ["id"], "dt", baseline_labels,
                       tie_breaks=[F.col("updated_at").desc_nulls_last()])
    linked = link_catalogues(prepare_catalogue_a(a), prepare_catalogue_b(b),
                             ["norm_name", "release_year"],
                             ["rawg_norm_name", "rawg_release_year"],
                             [F.col("rawg_id").asc()])
    linked = linked.na.fill(RAWG_DEFAULTS)
    if stats is None:
        return linked
    return attach_stats(linked, stats, "steam_appid", "steam_appid", STAT_DEFAULTS)


def as_of_filter(df: DataFrame, version_col: str, as_of: str | None,
                 baseline_labels: Sequence[str] = ("initial",)) -> DataFrame:
    """Keep loads up to ``as_of`` (plus the baseline); prunes ``dt=`` folders."""
    if as_of is None:
        return df
    label = F.col(version_col).cast("string")
    cond: Column = label <= F.lit(as_of)
    if baseline_labels:
        cond = cond | label.isin(list(baseline_labels))
    return df.filter(cond)


def pages(df: DataFrame, order_by, page_size: int, max_pages: int | None = None) -> DataFrame:
    """L3: pages of ``page_size`` rows under a total order, each row tagged with
    its 1-based ``page``; all pages, or the first ``max_pages``.

    All pages are numbered range by range: rows are dealt into sorted ranges
    and written once, a range's rows are numbered in its own window, and the
    ranges' sizes (one row each) give its offset.  The first ``max_pages`` are
    an ordered limit (a top-N per partition, then one bounded merge), numbered
    in one window of at most ``page_size * max_pages`` rows.
    """
    from pyspark.sql import Window

    if max_pages is None:
        from playlens.session import materialize

        ranged = materialize(df.repartitionByRange(*order_by).withColumn("_range", F.spark_partition_id()), "pages")
        sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
        before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
        pos = F.row_number().over(Window.partitionBy("_range").orderBy(*order_by)) + F.col("_before")
        return (ranged.join(F.broadcast(before), "_range")  # one row per range
                .withColumn("page", F.floor((pos - 1) / page_size).cast("int") + 1).drop("_range", "_before"))
    top = df.orderBy(*order_by).limit(page_size * max_pages)
    pos = F.row_number().over(Window.orderBy(*order_by))
    return top.withColumn("page", ((pos - 1) / page_size).cast("int") + 1)
