"""Keyed tables: Parquet in partitions by key hash, upserted by rewriting only
the partitions that change (S8, K5-K8, O10).

A table is a plain partitioned Parquet folder; ``key_bucket_of_<n>`` names the
partition column, so the number of buckets is read from the table itself.  An
upsert reads the buckets its source touches, merges, writes the result to the
shared scratch folder and from there replaces the changed buckets by Spark's
dynamic partition overwrite.  A run that dies in between is simply run again:
the merge is idempotent.  One writer at a time, as for any Parquet folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.operators.upsert import merge_rows, refused_keys, table_rows
from playlens.session import materialize

BUCKET = "key_bucket_of_"
BUCKETS = 64


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table with its bucket column, or None where nothing is stored."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _bucket_column(df: DataFrame) -> str:
    return next(c for c in df.columns if c.startswith(BUCKET))


def table_exists(spark: SparkSession, path: str) -> bool:
    return _stored(spark, path) is not None


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The table as it stands."""
    df = spark.read.parquet(path)
    return df.drop(_bucket_column(df))


def _write(df: DataFrame, path: str, keys: Sequence[str], buckets: int, mode: str) -> None:
    name = f"{BUCKET}{buckets}"
    # rebalanced by bucket: one file per bucket, several where a bucket is large
    (df.withColumn(name, bucket_of(keys, buckets)).hint("rebalance", name)
     .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(path))


def init_keyed(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """K5: a new table of ``df``; an existing one is an error."""
    _write(df, path, keys, buckets, "errorifexists")


def upsert_keyed(source: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """K6: merge ``source`` into the table by ``keys``; creates a table that isn't there.

    Returns ``(keys..., status, n_source)`` of the source keys that were refused
    (NULL or repeated), read from the written merge.  Only buckets with an
    inserted or updated row are rewritten.  Of a new table ``buckets`` is the
    number of partitions; an existing one keeps its own.
    """
    spark, keys = source.sparkSession, list(keys)
    stored = _stored(spark, path)
    if stored is None:
        merged = materialize(merge_rows(source.limit(0), source, keys), "merged")
        init_keyed(table_rows(merged), path, keys, buckets)
        return refused_keys(merged)
    name = _bucket_column(stored)
    buckets = int(name[len(BUCKET):])
    # written once: it is read for its buckets and for the merge
    source = materialize(source, "upsert-source")
    touched = [r[0] for r in source.select(bucket_of(keys, buckets).alias("b")).distinct().collect()]  # <= buckets
    target = stored.where(F.col(name).isin(touched)).drop(name)
    merged = materialize(merge_rows(target, source, keys), "merged")
    at = bucket_of([f"row.{k}" for k in keys], buckets)
    changed = [r[0] for r in merged.where(F.col("status").isin("inserted", "updated")).select(at.alias("b")).distinct().collect()]
    if changed:
        _write(table_rows(merged.where(F.col("row").isNotNull() & at.isin(changed))), path, keys, buckets, "overwrite")
    return refused_keys(merged)


def to_documents(df: DataFrame, id_col: str) -> DataFrame:
    """P10/K7/K8: ``(doc_id string, body json)`` documents keyed by id."""
    return df.select(F.col(id_col).cast("string").alias("doc_id"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("body"))


def serve_upsert(df: DataFrame, id_col: str, index_path: str, buckets: int = BUCKETS) -> DataFrame:
    """O10 (catalogue): documents keyed by ``id_col`` upserted into the document
    table; documents absent from ``df`` stay (stale docs kept).  Returns
    the refused ids."""
    return upsert_keyed(to_documents(df, id_col), index_path, ["doc_id"], buckets)


def serve_replace(df: DataFrame, id_col: str, index_path: str) -> None:
    """O10 (recommendations): the document set is replaced as a whole."""
    # written beside first: the old set may be what ``df`` reads
    docs = materialize(to_documents(df, id_col), "documents")
    docs.write.mode("overwrite").parquet(index_path)
