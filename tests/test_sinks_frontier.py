import glob
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from playlens.operators import frontier as fr
from playlens.operators.upsert import merge_rows, refused_keys, rejected, upsert
from playlens.sources import keyed, sinks
from tests.conftest import rows

T = "id long, v string"


def test_upsert_leaves_one_row_of_a_key_held_twice(spark):
    target = spark.createDataFrame([(0, ""), (0, "old"), (1, "b"), (1, "b"), (None, "n")], "id long, v string")
    source = spark.createDataFrame([(0, "new"), (1, "x"), (1, "y"), (None, "z")], "id long, v string")
    assert rows(upsert(target, source, ["id"])) == [(0, "new"), (1, "b"), (1, "b"), (None, "n")]


def test_upsert_semantics(spark):
    target = spark.createDataFrame([(1, "old"), (2, "keep")], T)
    source = spark.createDataFrame([(1, "new"), (3, "ins"), (None, "nullkey"), (4, "d1"), (4, "d2")], T)
    out = upsert(target, source, ["id"])
    assert rows(out) == [(1, "new"), (2, "keep"), (3, "ins")]
    assert rows(rejected(source, ["id"]), "v") == [("d1",), ("d2",), ("nullkey",)]
    assert rows(upsert(out, source, ["id"])) == rows(out)          # idempotent


def test_merge_rows_status(spark):
    target = spark.createDataFrame([(1, "old"), (2, "keep"), (4, "held"), (None, "odd")], T)
    source = spark.createDataFrame([(1, "new"), (3, "ins"), (None, "x"), (None, "y"), (4, "d1"), (4, "d2"), (5, "e"), (5, "e")], T)
    merged = merge_rows(target, source, ["id"])
    got = [(r.status, r.n_source, r.key.id if r.key else None, tuple(r.row) if r.row else None) for r in merged.collect()]
    assert sorted(got, key=repr) == sorted([
        ("updated", 1, 1, (1, "new")), ("kept", 0, None, (2, "keep")), ("kept", 0, None, (None, "odd")),
        ("inserted", 1, 3, (3, "ins")), ("null_key", 2, None, None),
        ("duplicate_key", 2, 4, (4, "held")), ("duplicate_key", 2, 5, None)], key=repr)
    assert rows(refused_keys(merged)) == [(4, "duplicate_key", 2), (5, "duplicate_key", 2), (None, "null_key", 2)]


def _files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(os.path.join(path, "*", "*.parquet"))}


def test_keyed_table_rewrites_only_what_changes(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="pl-table-"), "items")
    assert not keyed.table_exists(spark, path)
    first = spark.range(1000).select("id", F.lit("a").alias("v"))
    assert keyed.upsert_keyed(first, path, ["id"], buckets=16).count() == 0
    before = _files(path)
    assert len({os.path.dirname(f) for f in before}) == 16
    refused = keyed.upsert_keyed(spark.createDataFrame([(3, "B"), (2000, "new"), (7, "x"), (7, "y")], T), path, ["id"])
    assert rows(refused) == [(7, "duplicate_key", 2)]
    kept = set(before) & set(_files(path))
    assert {os.path.dirname(f) for f in set(before) - kept} <= {os.path.dirname(f) for f in before}
    assert 14 <= len({os.path.dirname(f) for f in kept}) < 16            # at most two buckets were rewritten
    now = {r.id: r.v for r in keyed.read_keyed(spark, path).collect()}
    assert len(now) == 1001 and now[3] == "B" and now[2000] == "new" and now[7] == "a" and now[999] == "a"
    # only refused keys: nothing is written
    before = _files(path)
    keyed.upsert_keyed(spark.createDataFrame([(None, "x")], T), path, ["id"])
    assert _files(path) == before
    with pytest.raises(Exception):
        keyed.init_keyed(first, path, ["id"])


def test_served_documents(spark):
    root = tempfile.mkdtemp(prefix="pl-docs-")
    path, other = os.path.join(root, "kept"), os.path.join(root, "replaced")
    one, two = spark.createDataFrame([(1, "a"), (2, "b")], T), spark.createDataFrame([(2, "B"), (3, "c")], T)
    for df in (one, two):
        keyed.serve_upsert(df, "id", path, buckets=4)
        keyed.serve_replace(df, "id", other)
    body = {r.doc_id: json.loads(r.body)["v"] for r in keyed.read_keyed(spark, path).collect()}
    assert body == {"1": "a", "2": "B", "3": "c"}                        # the stale document stays
    assert rows(spark.read.parquet(other), "doc_id") == [("2",), ("3",)]


def test_write_partition_and_documents(spark):
    root = tempfile.mkdtemp(prefix="pl-silver-")
    df = spark.createDataFrame([(1, "x")], T)
    sinks.write_partition(df, root, "initial", files=2)
    sinks.write_partition(df.withColumn("v", F.lit("y")), root, "20240101")
    sinks.write_partition(df.withColumn("v", F.lit("z")), root, "20240101")       # replaced, not added
    back = spark.read.parquet(root)
    assert rows(back, "dt", "v") == [("20240101", "z"), ("initial", "x")]
    doc = sinks.to_documents(df, "id").first()
    assert doc.doc_id == "1" and json.loads(doc.body) == {"id": 1, "v": "x"}
    with sinks.materialized(df) as counts:
        assert counts == [1]


def test_bfs_processes_each_node_once(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "node string")
    state = fr.bfs(edges, seeds, steps=10, batch=1)
    got = rows(state, "node", "status")
    assert got == [("a", "processed"), ("b", "processed"), ("c", "processed"), ("d", "processed")]
    one = fr.frontier_step(edges, fr.seed_state(seeds), batch=1)
    assert rows(one, "node", "status") == [("a", "processed"), ("b", "queued")]


def test_as_of_prunes_load_partitions(spark):
    from playlens.operators.resolve import as_of_filter
    from playlens.sources.readers import read_silver

    root = tempfile.mkdtemp(prefix="pl-asof-")
    for dt, v in (("initial", "bulk"), ("20240101", "d1"), ("20240102", "d2")):
        sinks.write_partition(spark.createDataFrame([(1, v)], T), root, dt)
    df = as_of_filter(read_silver(spark, root), "dt", "20240101")
    assert rows(df, "v") == [("bulk",), ("d1",)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "20240101" in plan.split("PartitionFilters: [")[1].split("]")[0]
