"""K6: keyed upsert as a DataFrame operation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is fully non-NULL and occurs exactly once."""
    keys = list(keys)
    nonnull = source.filter(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    dup = nonnull.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
    return nonnull.join(dup, keys, "left_anti")


def rejected(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows refused by ``upsert`` (NULL or duplicated key)."""
    return source.exceptAll(valid_source(source, keys))


def _one_row_per_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source keys ``_q0``..., how many rows have each (``_n``) and one of these in the target's types (``_s``)."""
    typed = source.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in target.columns])
    return typed.groupBy(*[F.col(k).alias(f"_q{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(*target.columns)).alias("_s"))


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target and source in one pass: ``(status, n_source, key, row)``.

    ``status`` is ``kept`` (target only), ``updated``, ``inserted``,
    ``null_key`` or ``duplicate_key``; ``row`` is what the table holds afterwards
    (NULL where it holds nothing for a refused key), ``key`` the source's key and
    ``n_source`` how many source rows have it.  The source is reduced to
    one row per key before the join (map-side, so a key that a third of the
    source repeats is no hot key), then one full outer join meets the target.
    Target rows with a NULL key, or with a key twice, all stay.
    """
    keys, cols = list(keys), target.columns
    one = _one_row_per_key(target, source, keys)
    held = target.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*cols).alias("_t"))
    same, null_key = F.lit(True), F.lit(False)
    for i in range(len(keys)):
        same = same & (F.col(f"_k{i}") == F.col(f"_q{i}"))
        null_key = null_key | F.col(f"_q{i}").isNull()
    status = (F.when(F.col("_n").isNull(), "kept").when(null_key, "null_key").when(F.col("_n") > 1, "duplicate_key")
              .when(F.col("_t").isNull(), "inserted").otherwise("updated"))
    return held.join(one, same, "full_outer").select(
        status.alias("status"), F.coalesce("_n", F.lit(0)).alias("n_source"),
        F.struct(*[F.col(f"_q{i}").alias(k) for i, k in enumerate(keys)]).alias("key"),
        F.when(status.isin("inserted", "updated"), F.col("_s")).otherwise(F.col("_t")).alias("row"))


def table_rows(merged: DataFrame) -> DataFrame:
    """What the table holds after ``merge_rows``."""
    return merged.where(F.col("row").isNotNull()).select("row.*")


def refused_keys(merged: DataFrame) -> DataFrame:
    """``(keys..., status, n_source)`` of the source keys that ``merge_rows`` refused."""
    return merged.where(F.col("status").isin("null_key", "duplicate_key")).select("key.*", "status", "n_source")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           reject_invalid: bool = True) -> DataFrame:
    """Matched keys take the source row (all columns), new keys are inserted,
    target rows without a source match are kept.  A key that the target holds
    twice has one row afterwards, the source's.

    Source rows with a NULL or repeated key change nothing; ``merge_rows`` says
    which.  ``reject_invalid=False`` trusts the source: target rows are
    kept with a left-anti join on the keys and the source is appended.
    """
    if reject_invalid:
        valid = " AND ".join(["_n = 1", *[f"_q{i} IS NOT NULL" for i in range(len(keys))]])
        source = _one_row_per_key(target, source, keys).where(valid).select("_s.*")
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))
