"""Drain pending files into a Parquet table, exactly once.

Both use a file-source stream with ``trigger(availableNow=True)``: every
file present at start is processed (in bounded micro-batches when
``max_files_per_trigger`` is set), progress is committed to the checkpoint
after each batch, and a rerun only picks up files it has not seen.  The
checkpoint is what makes a killed run resumable.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.functions.scalar import safe_ts
from playlens.operators.engagement import library_ok
from playlens.sources.readers import stream_raw_json
from playlens.sources.schemas import LIBRARY_SCHEMA


#: Progress reports that a run keeps, so that its counts cover every micro-batch.
KEPT_REPORTS = 1_000_000


def run_counted(sdf: DataFrame, out_dir: str, checkpoint_dir: str, partition_by: list[str] | None = None,
                counts: Mapping[str, Column] | None = None, keep: Column | None = None) -> dict:
    """K3: append a streaming frame to Parquet until the source is drained.

    Returns ``batches`` and the sum of each of ``counts`` (aggregates over all
    rows of a micro-batch, which ride with its write).  With ``keep``
    only rows for which it holds are written, so what is left out can be counted by the same
    pass.  Every micro-batch of this run is counted, however many there are.
    """
    name, spark = "load", sdf.sparkSession
    if counts:
        sdf = sdf.observe(name, *[c.alias(n) for n, c in counts.items()])
    if keep is not None:
        sdf = sdf.where(keep)
    w = (sdf.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir)
         .outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    setting = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(KEPT_REPORTS))
    try:
        q = w.start(out_dir)
        q.awaitTermination()
    finally:
        spark.conf.set(setting, before)
    if q.exception() is not None:
        raise q.exception()
    out = {"batches": 0, **{n: 0 for n in counts or {}}}
    for report in q.recentProgress:
        out["batches"] += 1
        seen = report.observedMetrics.get(name)
        for n in counts or {}:
            out[n] += (seen[n] or 0) if seen is not None else 0
    return out


def run_available_now(sdf: DataFrame, out_dir: str, checkpoint_dir: str,
                      partition_by: list[str] | None = None) -> int:
    """As ``run_counted``; returns the number of micro-batches that ran."""
    return run_counted(sdf, out_dir, checkpoint_dir, partition_by)["batches"]


def consolidate_libraries(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str,
                          max_items: int | None = None, schema: str = LIBRARY_SCHEMA,
                          max_files_per_trigger: int | None = None) -> dict:
    """O3: raw library files -> typed, valid libraries (stateless stream).

    Returns ``batches``, ``read`` and ``rejected`` records, counted as they are written.
    """
    raw = stream_raw_json(spark, source_dir, schema, max_files_per_trigger)
    shaped = raw.select("steam_id", safe_ts("scraped_at").alias("scraped_at"), "games")
    ok = library_ok("steam_id", "games", max_items)
    return run_counted(shaped, out_dir, checkpoint_dir, keep=ok, counts={
        "read": F.count(F.lit(1)), "rejected": F.count_if(~F.coalesce(ok, F.lit(False)))})


def load_batches(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str,
                 schema: str, fmt: str = "json", files_per_batch: int | None = None,
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 path_glob: str | None = None, options: dict | None = None) -> int:
    """Resumable bulk load of a folder of files, ``files_per_batch`` at a
    time; the checkpoint records which files are done."""
    r = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    if path_glob:
        r = r.option("pathGlobFilter", path_glob)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    sdf = r.load(source_dir)
    if transform is not None:
        sdf = transform(sdf)
    return run_available_now(sdf, out_dir, checkpoint_dir)


def with_load_time(sdf: DataFrame, col: str = "loaded_at") -> DataFrame:
    return sdf.withColumn(col, F.current_timestamp())
