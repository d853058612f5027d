"""Session defaults and the shared checkpoint location."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: instants in UTC, ANSI arithmetic (all
# lenient parsing is done with try_* functions instead), and adaptive
# execution so partition counts, join strategies and skewed partitions are
# decided from runtime statistics.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}

#: In-memory size of a Parquet table's rows over its file size, about.  Encoded ids and
#: cohorts are a tenth of their rows: by file size, whole user tables would be
#: broadcast through the driver.
FILE_FACTOR = "8.0"


def size_tables(spark: SparkSession) -> None:
    """Let joins judge Parquet tables by the size of their rows."""
    spark.conf.set("spark.sql.sources.fileCompressionFactor", FILE_FACTOR)


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "playlens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are only set when given, so a
    cluster submit keeps its own values.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL defaults to an existing session."""
    for k, v in SESSION_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session: keep its value
            pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (what the cluster names).  Only a local
    session, as in tests, may leave it unset and gets a private folder; on a
    cluster, where executors would write to their own disks, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="playlens-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # a session may refuse core settings at runtime
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "stage"):
    """Cut lineage by writing ``df`` as a Parquet table in the shared
    checkpoint folder and reading it back.

    Used for intermediate tables read by several branches of one job (each
    branch would otherwise recompute the scans, joins and aggregations below
    it).  One pass writes it (an RDD checkpoint of an unpersisted frame runs
    the lineage twice); readers get column pruning and filter pushdown; and
    a lost executor recomputes nothing below the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def cluster_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict:
    """Shuffle and scan sizing for a cluster run over ``input_bytes``.

    The initial shuffle width gives each partition about ``partition_bytes``
    of input (and at least 3 tasks per core); AQE then coalesces small
    partitions and splits skewed ones at runtime.  Scan splits stay at
    128 MiB so every task's input fits executor memory.
    """
    initial = max(3 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }
