"""Sinks (K1-K4, K9): partition overwrite, file sizes, gold overwrite, and
writes that count their rows as they write.  Keyed tables are in ``keyed.py``."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playlens.sources.keyed import serve_replace, serve_upsert, to_documents  # noqa: F401


@contextlib.contextmanager
def file_bytes(spark: SparkSession, n: int):
    """K2: within the block, rebalanced writes aim at files of about ``n`` bytes (before compression)."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def sized(df: DataFrame, by: str | None = None) -> DataFrame:
    """K2: rows rebalanced into files of the session's advisory size (see
    ``file_bytes``), each ``by`` value in few files.

    Adaptive execution merges small partitions and splits large or skewed ones
    from their measured sizes, so the number of files follows the data."""
    return df.hint("rebalance", by) if by else df.hint("rebalance")


def write_partition(df: DataFrame, root: str, dt: str, files: int | None = None) -> str:
    """K1/K2: replace the single load partition ``dt=<dt>``, leave the others.

    Files follow the data's size (``sized``); ``files`` asks for that many
    instead, dealt by a full repartition (all tasks write).
    """
    out = df.repartition(files) if files else sized(df)
    path = f"{root.rstrip('/')}/dt={dt}"
    out.write.mode("overwrite").parquet(path)
    return path


def write_loads(df: DataFrame, root: str, dt_col: str = "dt") -> None:
    """K1 for several loads at once: replaces exactly the ``dt=`` partitions that
    ``df`` has rows for (dynamic partition overwrite)."""
    (sized(df, by=dt_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(dt_col).parquet(root))


def write_gold(df: DataFrame, path: str, max_records_per_file: int | None = None) -> None:
    """K4: full overwrite of a derived table."""
    w = sized(df).write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def write_counted(df: DataFrame, write: Callable[[DataFrame], object], counts: Mapping[str, Column],
                  keep: Column | None = None) -> dict:
    """Write ``df`` and return metrics of the rows taken on the way.

    ``counts`` are aggregates over all rows of ``df``; with ``keep`` only rows
    for which it holds are written, so rejects are counted by the pass
    that leaves them out.  Nothing is read a second time: the metrics ride
    with the write (``DataFrame.observe``).  A stage that Spark runs again
    after losing an executor counts its rows once, if the write is its last
    stage, as here."""
    seen = Observation()
    rows = df.observe(seen, *[c.alias(name) for name, c in counts.items()])
    write(rows.where(keep) if keep is not None else rows)
    return seen.get


def counted_if(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


@contextlib.contextmanager
def materialized(*frames: DataFrame):
    """K9: persist frames used several times, count once, release after."""
    for f in frames:
        f.persist()
    try:
        yield [f.count() for f in frames]
    finally:
        for f in frames:
            f.unpersist()
