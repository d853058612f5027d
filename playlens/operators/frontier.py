"""Breadth-first expansion of a crawl frontier over an edge table.

State is a table ``(node, status)`` with status ``queued`` or
``processed``; edges are ``(src, dst)``.  One step takes the first
``batch`` unprocessed queued nodes (by node id), discovers their
neighbours that are not yet known, marks the batch processed and queues
the discoveries.  All set algebra is joins and unions; the only bounded
piece is the batch itself (``batch`` rows, broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from playlens.operators.joins import broadcast_if_bounded

#: Largest frontier that is broadcast to the edges.
BROADCAST_NODES = 100_000
QUEUED, PROCESSED = "queued", "processed"


def seed_state(seeds: DataFrame, node: str = "node") -> DataFrame:
    return seeds.select(F.col(node).alias("node")).distinct().withColumn("status", F.lit(QUEUED))


def frontier_step(edges: DataFrame, state: DataFrame, batch: int | None = 50, n_queued: int | None = None) -> DataFrame:
    """One step: the first ``batch`` queued nodes (None: all) are processed.

    ``n_queued`` bounds the queued nodes, if known; a batch that is proven
    small is broadcast, so the edges are filtered where they lie."""
    processed = state.filter(F.col("status") == PROCESSED).select("node").distinct()
    queue = state.filter(F.col("status") == QUEUED).select("node").distinct()
    known = state.select("node").distinct()                                     # G1
    candidates = queue.join(processed, "node", "left_anti")                     # G1
    chosen = candidates if batch is None else candidates.orderBy("node").limit(batch)   # L4
    small = min((n for n in (batch, n_queued) if n is not None), default=None)
    asked = broadcast_if_bounded(chosen.withColumnRenamed("node", "src"), small, BROADCAST_NODES)
    nbrs = (edges.join(asked, "src")
            .select(F.col("dst").alias("node")).distinct())                     # G2
    discovered = nbrs.join(known, "node", "left_anti")
    done = processed.unionByName(chosen).distinct()                             # G3
    new_queue = queue.unionByName(discovered).distinct().join(done, "node", "left_anti")
    return (done.withColumn("status", F.lit(PROCESSED))
            .unionByName(new_queue.withColumn("status", F.lit(QUEUED))))


def bfs(edges: DataFrame, seeds: DataFrame, steps: int | None = None, batch: int | None = None,
        checkpoint: bool = True, node: str = "node") -> DataFrame:
    """Frontier steps from ``seeds`` until no queued node is left (or
    ``steps`` are done).  The state is checkpointed (reliably, to the
    session's checkpoint folder) after each step so lineage stays one step
    deep and a lost executor recomputes at most one step.  A small frontier is
    broadcast; before the first large one the edges are dealt by ``src`` and kept on
    the executors' disks, so all later steps shuffle nodes only."""
    from playlens.session import checkpoint_root

    state = seed_state(seeds, node)
    if checkpoint:
        checkpoint_root(state.sparkSession)
    done, dealt = 0, None
    while steps is None or done < steps:
        done += 1
        n_queued = state.filter(F.col("status") == QUEUED).count()
        if not n_queued:
            break
        if checkpoint and dealt is None and min(n_queued, batch or n_queued) > BROADCAST_NODES:
            width = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            edges = dealt = edges.repartition(width, "src").persist(StorageLevel.DISK_ONLY)
        state = frontier_step(edges, state, batch, n_queued)
        if checkpoint:
            state = state.checkpoint(eager=True)
    if dealt is not None:
        dealt.unpersist()
    return state
