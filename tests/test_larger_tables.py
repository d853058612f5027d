"""Work that grows with the tables: written once, dealt by rows, broadcast by proof."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from playlens.operators import features as feat
from playlens.operators import frontier as fr
from playlens.operators import recommend as rec
from playlens.plans import catalogues as C
from playlens.plans import queries as Q
from playlens.plans import queries2 as Q2
from playlens.session import materialize, size_tables
from tests.conftest import plan_text


@pytest.fixture
def tables(spark):
    root = tempfile.mkdtemp(prefix="pl-large-")

    def put(name, df):
        df.coalesce(1).write.parquet(os.path.join(root, f"{name}.parquet"))

    n = spark.range(1, 241)
    put("part", n.select(F.col("id").alias("p_partkey"), F.concat_ws(" ", F.lit("red"), F.concat(F.lit("w"), F.col("id") % 7)).alias("p_name"),
                         F.concat(F.lit("Brand#"), F.col("id") % 3).alias("p_brand"), F.concat(F.lit("T"), F.col("id") % 5).alias("p_type"),
                         (F.col("id") % 50 + 1).cast("int").alias("p_size"), (F.col("id") + 0.5).alias("p_retailprice")))
    put("customer", n.where("id <= 40").select(F.col("id").alias("c_custkey"), F.concat(F.lit("S"), F.col("id") % 2).alias("c_mktsegment")))
    put("orders", n.select(F.col("id").alias("o_orderkey"), (F.col("id") % 40 + 1).alias("o_custkey")))
    put("lineitem", spark.range(960).select((F.col("id") % 240 + 1).alias("l_orderkey"), (F.col("id") * 7 % 240 + 1).alias("l_partkey"),
                                            F.lit(3.0).alias("l_quantity"), F.lit("O").alias("l_linestatus")))
    return root


def _writes(monkeypatch, *modules):
    """Names of the tables written, in order."""
    names = []

    def kept(df, name="stage"):
        names.append(name)
        return materialize(df, name)

    for m in modules:
        monkeypatch.setattr(m, "materialize", kept)
    return names


def test_cohorts_are_learned_from_written_features(spark, tables, monkeypatch):
    names = _writes(monkeypatch, feat, Q, Q2)
    out = Q2.q_learned_recommend(spark, tables)
    # one K-Means flow over one set of interactions; its assignments are not predicted again
    assert [names.count(n) for n in ("interactions", "user-tags", "tag-arrays", "features", "cohorts", "labelled")] == [1] * 6
    assert "UDF" not in plan_text(out) and out.count() <= 40
    assign, pred = feat.assign_cohorts(spark.createDataFrame([(i, ["a", "b"][: i % 2 + 1]) for i in range(20)], "u long, all_tags array<string>"),
                                       "u", k=2, min_df=1)
    assert {"u", "features", "cohort_id"} <= set(pred.columns) and assign.count() == 20


def test_recommendations_are_ranked_once(spark, tables, monkeypatch):
    names = _writes(monkeypatch, Q)
    Q.q_recommendation_scores(spark, tables)
    assert names.count("ranked") == 1


def test_records_are_shaped_by_many_tasks(spark, tables, monkeypatch):
    whole = C.raw_catalogue_a(spark, tables).select("id", "updated_at").collect(), C.raw_catalogue_b(spark, tables).select("id", "updated").collect()
    monkeypatch.setattr(C, "PART_ROWS", 50)
    for raw, before in zip((C.raw_catalogue_a(spark, tables), C.raw_catalogue_b(spark, tables)), whole):
        assert max(r["count"] for r in raw.groupBy(F.spark_partition_id().alias("p")).count().collect()) <= 50
        got = raw.select(*before[0].__fields__).collect()
        assert sorted(map(str, got)) == sorted(map(str, before))


def test_small_batches_filter_the_edges_in_place(spark):
    edges = spark.range(1000).select(F.concat(F.lit("n"), F.col("id")).alias("src"), F.concat(F.lit("n"), F.col("id") + 1).alias("dst"))
    state = fr.seed_state(spark.createDataFrame([("n5",), ("n7",)], "node string"))
    step = fr.frontier_step(edges.unionByName(edges), state, batch=1)
    assert "BroadcastHashJoin" in plan_text(step) and "HashedRelationBroadcastMode" in plan_text(step)
    assert sorted(map(tuple, step.collect())) == [("n5", "processed"), ("n6", "queued"), ("n7", "queued")]


def test_large_frontiers_deal_the_edges_once(spark, monkeypatch):
    edges = spark.createDataFrame([(f"n{i}", f"n{2 * i + b}") for i in range(1, 64) for b in (0, 1)], "src string, dst string")
    seeds = spark.createDataFrame([("n1",)], "node string")
    small = sorted(map(tuple, fr.bfs(edges, seeds).collect()))
    monkeypatch.setattr(fr, "BROADCAST_NODES", 3)
    assert sorted(map(tuple, fr.bfs(edges, seeds).collect())) == small and len(small) == 127


def test_repeated_labels_count_as_before(spark):
    inter = spark.createDataFrame([(1, 1, "x", 2.0), (1, 2, "y", 3.0), (2, 1, "x", 4.0), (None, 2, "y", 5.0)],
                                  "steam_id long, steam_appid long, game_name string, implicit_preference_score double")
    labels = spark.createDataFrame([(1, "A"), (1, "A"), (2, "A"), (2, "B")], "steam_id long, cohort_id string")
    want = rec.cohort_scores(inter, labels, min_score=0.0, max_share=9.0)
    got = rec.cohort_scores(inter, labels, min_score=0.0, max_share=9.0, unique_pairs=True, repeated_labels=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 3
    # the interactions are aggregated once, not first per user and item
    assert "cohort_id" in got.columns and plan_text(got).count("HashAggregate") < plan_text(want).count("HashAggregate") + 2


def test_tables_are_judged_by_their_rows(spark):
    users = materialize(spark.range(300_000).select("id", (F.col("id") % 8).cast("int").alias("c")), "users")
    before = spark.conf.get("spark.sql.sources.fileCompressionFactor")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4m")
        size_tables(spark)
        plan = spark.range(10_000_000).join(users, "id")._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.sources.fileCompressionFactor", before)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
