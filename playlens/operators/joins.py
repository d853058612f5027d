"""Join helpers with an explicit size rule for broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest row bound we broadcast on the caller's proof alone.
BROADCAST_MAX_ROWS = 2_000_000


def broadcast_if_bounded(df: DataFrame, row_bound: int | None,
                         max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only when the caller proves it has at most
    ``row_bound`` rows (e.g. cohorts x top-N) and that bound fits.

    Otherwise the frame is returned unchanged: the join stays a shuffle join
    and AQE may still turn it into a broadcast from the *measured* size, or
    split skewed partitions.
    """
    if row_bound is not None and row_bound <= max_rows:
        return F.broadcast(df)
    return df


#: Parts that rows without a key are dealt into.
NULL_PARTS = 1024


def left_join_nonnull_keys(left: DataFrame, right: DataFrame, left_keys, right_keys) -> DataFrame:
    """``left`` LEFT JOIN ``right`` ON equal keys, safe from NULL keys.

    A NULL key never matches, but in a sort-merge join every NULL-key row of the
    outer side hashes to the same partition: a catalogue where a third of the
    rows lack the key would put that third into one task.  Such rows carry a
    salt as one more join key (0 for all others), so they spread over the
    tasks of the one join; each side is planned and read once.  Right rows
    with a NULL key are dropped (they could not match).
    """
    left_keys, right_keys = list(left_keys), list(right_keys)
    missing = F.lit(False)
    for k in left_keys:
        missing = missing | F.col(k).isNull()
    # hashed from the row, so a task that runs again deals the same
    plain = [f.name for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    salt = F.when(missing, F.pmod(F.xxhash64(*plain), F.lit(NULL_PARTS)).cast("int") + 1).otherwise(F.lit(0))
    present = F.lit(True)
    for k in right_keys:
        present = present & F.col(k).isNotNull()
    a = left.withColumn("_salt", salt).alias("__l")
    b = right.filter(present).withColumn("_none", F.lit(0)).alias("__r")
    cond = F.col("__l._salt") == F.col("__r._none")
    for lk, rk in zip(left_keys, right_keys):
        cond = cond & (F.col(f"__l.{lk}") == F.col(f"__r.{rk}"))
    return a.join(b, cond, "left").select(*[F.col(f"__l.{c}") for c in left.columns],
                                          *[F.col(f"__r.{c}") for c in right.columns])
