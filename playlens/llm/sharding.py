"""Two-pass external shuffle into equal shards (DataFrame functions only).

Pass one scatters the records by a seeded hash into buckets small enough for
memory; each bucket is gathered, put through a Fisher-Yates shuffle (Spark's
``shuffle``) and written.  Pass two reads the written buckets: a record's
place in the whole order is its bucket's offset plus its place in the bucket,
and the order is cut into shards whose row counts differ by at most one.

The records cross the network once.  The hash is salted with the row's
number, so rows that share a key, however many, spread over all buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import materialize, parts_for, pick, prefix_offsets

SEED = 20240229
#: Text bytes in a bucket; one task holds a few buckets at most.
BUCKET_BYTES = 8 << 20


def shuffle_into_shards(rows: DataFrame, key_col: str, text_col: str, shards: int = 24,
                        seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All records in random order: ``key``, ``text``, ``shard`` (0 to
    ``shards`` - 1), ``slot`` (gapless from 0 in each shard).

    Shards take consecutive runs of the shuffled order; with fewer rows than
    shards some shards stay empty.  Null keys and texts, empty and very long
    texts and repeated rows are records like any other; an empty table gives
    no rows; other columns are ignored.
    """
    slim = pick(rows, key=key_col, text=text_col)
    total = slim.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 32)).first()[0]
    n = parts_for(total, bucket_bytes)
    numbered = slim.withColumn("no", F.monotonically_increasing_id())
    scattered = numbered.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "key", "no"), F.lit(n)))
    # sorted before it is shuffled, so the seed alone decides the order
    gathered = (scattered.repartition(n, "bucket").groupBy("bucket")
                .agg(F.array_sort(F.collect_list(F.struct("no", "key", "text"))).alias("all")))
    shuffled = materialize(gathered.select("bucket", F.posexplode(F.shuffle("all", seed)).alias("pos", "r"))
                           .select("bucket", "pos", "r.key", "r.text"), "shuffle")
    counts = shuffled.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = prefix_offsets(counts, "bucket", "n").select("bucket", "before")
    size = counts.agg(F.sum("n")).first()[0] or 0
    # rows before a shard: ceil(shard * size / shards)
    place = F.col("before") + F.col("pos")
    shard = F.expr(f"int((before + pos) * {shards} div {max(size, 1)})")
    first = F.expr(f"(shard * {size}L + {shards - 1}) div {shards}")
    if n <= 100_000:  # one short row per bucket
        offsets = F.broadcast(offsets)
    return (shuffled.join(offsets, "bucket").withColumn("shard", shard)
            .withColumn("slot", (place - first).cast("long")).select("key", "text", "shard", "slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard under ``path``, records in slot order within its files."""
    sharded.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
