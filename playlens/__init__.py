"""playlens: catalogue, cohort and recommendation operators on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from native
Spark expressions, joins, aggregations and windows, so Catalyst and AQE
choose the physical plan.  Sub-packages:

``functions``  column expressions (parsing, keys, scores)
``sources``    raw / silver / gold readers and sinks
``operators``  resolution, engagement, similarity, cohorts, recommendation
``streaming``  incremental file-stream loads
``plans``      the roles of the driver tables and the registered queries
"""

__all__ = ["session"]
