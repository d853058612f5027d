"""Connected components by distributed union-find (star contraction).

Every round replaces each link by links to the smallest neighbour (first
towards larger nodes, then towards smaller ones) until all nodes of a
component point at its smallest node.  Rounds are joins and map-side
aggregations over the links, so a hub with a third of all links is split by
adaptive skew handling and nothing is gathered on the driver but two numbers
per round.  Each round is written to the shared checkpoint folder, which cuts
the lineage and survives lost executors, and the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import discard, materialize


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "cc") -> DataFrame:
    """``(node, root)`` for every node with a link to another one.

    ``root`` is the smallest node of the component.  Self links and links
    with a null end are ignored, repeated links count once; no links give an
    empty frame.  Node columns may be of any orderable type.
    """
    x, y = F.col(a), F.col(b)
    e = materialize(edges.where(x.isNotNull() & y.isNotNull() & (x != y))
                    .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), name)
    mark = _mark(e)
    while mark[0]:
        both = e.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("v").alias("y")),
                                          F.struct(F.col("v").alias("x"), F.col("u").alias("y")))).alias("s")).select("s.*")
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = (both.join(low, "x").where(F.col("y") > F.col("x"))
                 .select(F.col("y").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s"))
                 .select("s.*").where("u <> v").distinct())
        spent, e = e, materialize(small, name)
        discard(spent)
        now = _mark(e)
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
