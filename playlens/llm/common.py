"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.session import checkpoint_root, materialize, scratch_path  # noqa: F401

#: ASCII letters to lower case, every other byte as it is.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by whatever file system the path names."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, renamed: ``pick(df, doc_id="id")`` takes column
    ``id`` as ``doc_id``.  Whatever else the frame carries, under whatever
    name, can clash with nothing that follows."""
    return df.select(*[df[src].alias(dst) for dst, src in cols.items()])


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base`` with underscores until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def parts_for(total_bytes: int, target: int) -> int:
    """How many parts of about ``target`` bytes hold ``total_bytes``."""
    return max(1, -(-int(total_bytes or 0) // target))


def discard(*frames: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, once everything made from them is written too.

    A lost executor then needs none of them; anything outside the checkpoint folder stays."""
    for frame in frames:
        spark = frame.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()[:1]}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
            root = fs.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(checkpoint_root(spark)))
            if fs.makeQualified(path.getParent()).equals(root):
                fs.delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of queries that are over: it does so when the driver's
    garbage collection meets their plans, which a roomy driver may put off for half an hour."""
    import gc

    gc.collect()
    spark._jvm.java.lang.System.gc()


def prefix_offsets(counts: DataFrame, key: str, n: str, group: int = 4096) -> DataFrame:
    """Add ``before``: the sum of ``n`` over all smaller integer keys.

    Two levels, so that no window holds more than ``group`` keys or the sums
    of the groups (keys / group rows).
    """
    from pyspark.sql import Window

    g = F.floor(F.col(key) / F.lit(group)).cast("long")
    grouped = counts.withColumn("_g", g)
    tops = (grouped.groupBy("_g").agg(F.sum(n).alias("_s"))
            .select("_g", (F.sum("_s").over(Window.orderBy("_g")) - F.col("_s")).alias("_top")))
    inner = F.sum(n).over(Window.partitionBy("_g").orderBy(key)) - F.col(n)
    return (grouped.withColumn("_in", inner).join(F.broadcast(tops), "_g")
            .withColumn("before", (F.col("_top") + F.col("_in")).cast("long"))
            .drop("_g", "_top", "_in"))


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers (once per context), so that
    tasks can import it wherever the session runs."""
    import os
    import shutil
    import tempfile

    import playlens

    sc = spark.sparkContext
    if getattr(sc, "_playlens_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(playlens.__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="playlens-py-"), "playlens_py")
    shutil.make_archive(base, "zip", root, "playlens")
    sc.addPyFile(base + ".zip")
    sc._playlens_shipped = True


def in_blocks(batch, at: int, block_bytes: int):
    """Cut a batch so that the texts of column ``at`` of a block hold about
    ``block_bytes`` (one longer text is a block of its own)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(at)), 0).cast(pa.int64()).to_numpy(zero_copy_only=False)
    block = np.cumsum(size) // block_bytes
    bounds = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(bounds, bounds[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def map_rows(df: DataFrame, uses: list[str], fn, fields: str, block_bytes: int | None = None) -> DataFrame:
    """Append columns that ``fn`` computes from Arrow batches of ``uses``.

    ``fn(list of arrays) -> list of arrays`` runs inside tasks, batch by
    batch; with ``block_bytes``, by blocks of about so many bytes of the first
    column of ``uses``.  All columns of ``df`` are carried by position, so
    their names may clash with anything; a new column whose name is taken gets
    underscores.
    """
    import pyarrow as pa
    from pyspark.sql import types as T

    at = [df.columns.index(c) for c in uses]
    n = len(df.columns)
    new = T.StructType.fromDDL(fields)
    inside = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema)]
                          + [T.StructField(f"n{i}", f.dataType) for i, f in enumerate(new)])
    names = [f.name for f in inside]

    def run(batches):
        for batch in batches:
            for b in in_blocks(batch, at[0], block_bytes) if block_bytes else [batch]:
                got = fn([b.column(i) for i in at])
                yield pa.RecordBatch.from_arrays([*b.columns, *got], names)

    out = df.toDF(*names[:n]).mapInArrow(run, inside)
    final = list(df.columns)
    for f in new:
        name = f.name
        while name.lower() in {c.lower() for c in final}:
            name += "_"
        final.append(name)
    return out.toDF(*final)


#: Keys that may be broadcast: those with at least 1/HEAVY of the whole weight, so at most HEAVY.
HEAVY = 65_536


def heavy_lookup(left: DataFrame, right: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Inner join of ``left`` with ``right`` (one row per key), safe from hot keys.

    ``weight`` of ``right`` says how often a key occurs.  At most ``HEAVY``
    keys can hold 1/HEAVY of the whole weight, so those are broadcast; the
    others, none of which is hot, meet their rows by a shuffled join.  Both
    frames are read twice: pass written tables."""
    total = right.agg(F.sum(weight)).first()[0] or 0
    is_heavy = F.col(weight) * F.lit(HEAVY) >= F.lit(total)
    heavy = F.broadcast(right.where(is_heavy))
    return (left.join(heavy, keys)
            .unionByName(left.join(heavy.select(*keys), keys, "left_anti").join(right.where(~is_heavy), keys)))
