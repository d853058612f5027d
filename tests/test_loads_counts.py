"""Counted writes and streams, raw files with bad records, loads whose columns
differ, chunked libraries, file sizes."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from playlens.operators import engagement as eng
from playlens.sources import sinks
from playlens.sources.readers import read_loads, read_raw_json_checked
from playlens.streaming.loads import consolidate_libraries, run_counted
from tests.conftest import plan_text, rows


def test_counts_ride_with_the_write(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="pl-count-"), "out")
    df = spark.range(100).withColumn("v", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")))
    got = sinks.write_counted(df, lambda d: d.write.parquet(path), keep=F.col("v").isNotNull(),
                              counts={"read": F.count(F.lit(1)), "rejected": sinks.counted_if(F.col("v").isNull())})
    assert got == {"read": 100, "rejected": 10}
    assert spark.read.parquet(path).count() == 90


def test_stream_counts_every_batch(spark):
    root = tempfile.mkdtemp(prefix="pl-batches-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    for i in range(120):  # more than the 100 reports that Spark keeps by default
        with open(os.path.join(src, f"{i:03}.json"), "w") as f:
            f.write(json.dumps({"id": i if i % 4 else None}))
    sdf = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).json(src)
    got = run_counted(sdf, os.path.join(root, "out"), os.path.join(root, "ck"), keep=F.col("id").isNotNull(),
                      counts={"read": F.count(F.lit(1)), "rejected": F.count_if(F.col("id").isNull())})
    assert got == {"batches": 120, "read": 120, "rejected": 30}
    assert spark.read.parquet(os.path.join(root, "out")).count() == 90


def test_libraries_report_rejects(spark):
    root = tempfile.mkdtemp(prefix="pl-libs-")
    src = os.path.join(root, "src")
    os.makedirs(src)
    for uid, n in (("a", 2), ("b", 0), ("c", 9), (None, 1)):
        with open(os.path.join(src, f"{uid}.json"), "w") as f:
            f.write(json.dumps({"steam_id": uid, "games": [{"appid": i} for i in range(n)]}))
    got = consolidate_libraries(spark, src, os.path.join(root, "out"), os.path.join(root, "ck"), max_items=5)
    assert (got["read"], got["rejected"]) == (4, 3)
    assert rows(spark.read.parquet(os.path.join(root, "out")), "steam_id") == [("a",)]


def test_bad_records_are_accounted_for(spark):
    d = tempfile.mkdtemp(prefix="pl-bad-")
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write(json.dumps([{"id": 1, "name": "x"}, {"name": "no id"}, {"id": "seven", "name": "odd"}], indent=1))
    with open(os.path.join(d, "b.json"), "w") as f:
        f.write('[{"id": 2, "name": "cut off"')
    good, bad = read_raw_json_checked(spark, os.path.join(d, "*.json"), "id long, name string")
    assert rows(good) == [(1, "x")]
    got = sorted((os.path.basename(r.source_file), r.reason) for r in bad.collect())
    assert got == [("a.json", "broken"), ("a.json", "no_key"), ("b.json", "broken")]
    assert all(r.record for r in bad.collect())


def test_loads_with_other_columns(spark):
    root = tempfile.mkdtemp(prefix="pl-cols-")
    sinks.write_partition(spark.createDataFrame([(1, "a", 5)], "id int, name string, extra int"), root, "20240101")
    sinks.write_partition(spark.createDataFrame([(2,)], "id long"), root, "20240102")
    df = read_loads(spark, root, "id long, name string, score double", {"name": "", "score": 0.0})
    assert df.columns == ["id", "name", "score", "dt"]
    assert rows(df) == [(1, "a", 0.0, "20240101"), (2, "", 0.0, "20240102")]
    one = read_loads(spark, root, "id long, name string", loads=["20240102"])
    assert rows(one) == [(2, None, "20240102")]
    assert "20240102" in plan_text(one).split("PartitionFilters: [")[1].split("]")[0]
    # schemas merged from the loads themselves
    other = tempfile.mkdtemp(prefix="pl-cols-")
    sinks.write_partition(spark.createDataFrame([(1, "a")], "id long, name string"), other, "20240101")
    sinks.write_partition(spark.createDataFrame([(2, 7)], "id long, extra int"), other, "20240102")
    assert rows(read_loads(spark, other).select("id", "name", "extra")) == [(1, "a", None), (2, None, 7)]


def test_chunked_libraries(spark):
    flat = [("u", i) for i in range(23)] + [("v", i) for i in range(5)] + [(None, 1)]
    df = spark.createDataFrame(flat, "user string, item long").repartition(7)
    got = {(r.user, r.chunk): (r["first"], r.n_games, [g.item for g in r.games])
           for r in eng.library_chunks(df, "user", ["item"], ["item"], size=10).collect()}
    assert got == {("u", 0): (0, 10, list(range(10))), ("u", 1): (10, 10, list(range(10, 20))),
                   ("u", 2): (20, 3, [20, 21, 22]), ("v", 0): (0, 5, list(range(5))), (None, 0): (0, 1, [1])}
    small = eng.library_chunks(df, "user", ["item"], ["item"], size=10, max_items=20, min_items=2)
    assert rows(small, "user") == [("v",)]
    assert eng.library_chunks(df.limit(0), "user", ["item"], ["item"]).count() == 0


def test_a_large_library_is_many_tasks(spark):
    df = spark.range(40_000).select(F.lit("hot").alias("user"), F.col("id").alias("item"))
    chunks = eng.library_chunks(df, "user", ["item"], ["item"], size=1000)
    got = chunks.select("chunk", "n_games", F.col("games")[0]["item"].alias("head")).collect()
    assert sorted((r.chunk, r.n_games, r["head"]) for r in got) == [(i, 1000, 1000 * i) for i in range(40)]


def test_files_follow_the_size(spark):
    root = tempfile.mkdtemp(prefix="pl-files-")
    df = spark.range(200_000).select("id", F.md5(F.col("id").cast("string")).alias("v")).repartition(40)
    sinks.write_gold(df, os.path.join(root, "one"))
    with sinks.file_bytes(spark, 1 << 20):
        sinks.write_gold(df, os.path.join(root, "many"))
    count = {n: len([f for f in os.listdir(os.path.join(root, n)) if f.endswith(".parquet")]) for n in ("one", "many")}
    assert count["one"] < count["many"] <= 40 and count["many"] >= 5
    loads = df.orderBy("id").limit(100).withColumn("dt", F.when(F.col("id") % 2 == 0, "a").otherwise("b"))
    sinks.write_loads(loads, os.path.join(root, "loads"))
    sinks.write_loads(loads.where("dt = 'b'").limit(1), os.path.join(root, "loads"))
    back = spark.read.parquet(os.path.join(root, "loads"))
    assert back.where("dt = 'b'").count() == 1 and back.where("dt = 'a'").count() == loads.where("dt = 'a'").count()
