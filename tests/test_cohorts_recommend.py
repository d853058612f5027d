import math

from pyspark.sql import functions as F

from playlens.operators import cohorts as coh
from playlens.operators import recommend as rec
from tests.conftest import plan_text, rows


def _lift_fixture(spark):
    assign = spark.createDataFrame([(f"a{i}", 0) for i in range(4)] + [(f"b{i}", 1) for i in range(6)],
                                   "steam_id string, cohort_id int")
    tags = spark.createDataFrame([(f"a{i}", "t") for i in range(4)] + [("b0", "t"), ("b0", "t")],
                                 "steam_id string, tag string")
    return assign, tags


def test_tag_lift_values(spark):
    assign, tags = _lift_fixture(spark)
    out = {r.cohort_id: r for r in coh.tag_lift(tags, assign, n_cohorts=2).collect()}
    assert out[0].lift == 2.0 and math.isclose(out[1].lift, 1 / 3)
    assert out[1].cohort_tag_users == 1 and out[0].global_tag_users == 5       # distinct users
    sizes = coh.cohort_sizes(assign).agg(F.sum("cohort_size")).first()[0]
    assert sizes == assign.count()


def test_stop_tags_and_unknown_cohort(spark):
    assign = spark.createDataFrame([("u1", 0), ("u2", 0), ("u3", 1)], "steam_id string, cohort_id int")
    tags = spark.createDataFrame([(u, t) for u in ("u1", "u2") for t in ("steam_cloud", "open_world", "rts")],
                                 "steam_id string, tag string")
    names = coh.cohort_names(coh.tag_lift(tags, assign), min_users=1, min_share=0.1)
    assert rows(names) == [(0, "Cluster 0 (rts Fans)")]
    lab = coh.label_users(assign, names)
    assert dict(rows(lab, "steam_id", "cohort_name"))["u3"] == coh.UNKNOWN_COHORT


INTER = "steam_id string, steam_appid long, game_name string, implicit_preference_score double"


def _reco_fixture(spark):
    inter = spark.createDataFrame([
        ("u1", 1, "One", 2.0), ("u1", 2, "Two", 1.0),
        ("u2", 1, "Uno", 2.0), ("u2", 3, "Three", 1.0),
        ("u3", 4, None, 1.0),
        ("u4", 1, "One", 0.5), ("u4", 2, "Two", 0.5), ("u4", 3, "Three", 0.5), ("u4", 4, None, 0.5),
    ] + [(f"x{i}", 100 + i, "pad", 0.1) for i in range(8)], INTER)
    users = inter.select("steam_id").distinct()
    cohort = F.when(F.col("steam_id").startswith("x"), F.lit(1)).otherwise(F.lit(0))
    labelled = users.select("steam_id", cohort.alias("cohort_id"), F.lit("Cluster (x Fans)").alias("cohort_name"))
    return inter, labelled


def test_recommend_excludes_owned_and_breaks_ties_by_id(spark):
    inter, labelled = _reco_fixture(spark)
    ranked = rec.recommend(inter, labelled, min_score=0.0, max_share=0.5, per_cohort=30, per_user=2, n_cohorts=2)
    got = {}
    for r in ranked.orderBy("steam_id", "reco_rank").collect():
        got.setdefault(r.steam_id, []).append(r.steam_appid)
    assert got["u1"] == [3, 4] and got["u2"] == [2, 4] and got["u3"] == [1, 2]
    assert "u4" not in got                          # owns every candidate: no row
    owned = set(rows(inter, "steam_id", "steam_appid"))
    assert not owned & set(rows(ranked, "steam_id", "steam_appid"))
    # renamed item 1 is one candidate, carrying one name
    assert ranked.filter("steam_appid = 1").select("item_name").distinct().count() == 1
    assert "BroadcastHashJoin" in plan_text(ranked)


def test_pack_keeps_names_and_scores_aligned(spark):
    inter, labelled = _reco_fixture(spark)
    ranked = rec.recommend(inter, labelled, min_score=0.0, max_share=0.5, per_user=3)
    packed = {r.steam_id: r for r in rec.pack_recommendations(ranked).collect()}
    u1 = packed["u1"]
    assert u1.recommended_ids == [3, 4] and u1.recommended_games == ["Three", None]
    assert len(u1.recommendation_scores) == 2 and u1.recommendation_scores[0] >= u1.recommendation_scores[1]


def test_not_ubiquitous_strict_share(spark):
    data = [(f"u{u}", item, 1.0) for item, n in ((1, 1), (2, 2), (3, 3)) for u in range(n)]
    data += [(f"u{u}", 9, 1.0) for u in range(3, 10)]  # ten users in total
    inter = spark.createDataFrame(data, "steam_id string, steam_appid long, implicit_preference_score double")
    pop = rec.not_ubiquitous(rec.item_popularity(inter), rec.total_users(inter), 0.20)
    assert rows(pop, "steam_appid") == [(1,)]


def test_preview_is_ordered_and_bounded(spark):
    from playlens.operators.reports import preview

    df = spark.createDataFrame([(i, f"u{i}") for i in range(20)], "id long, steam_id string")
    assert [r.id for r in preview(df, [F.col("id").desc()], 5).collect()] == [19, 18, 17, 16, 15]


def test_assignments_frame_and_bounded_names(spark):
    inter, labelled = _reco_fixture(spark)
    base = rec.recommend(inter, labelled, min_score=0.0, max_share=0.5, per_user=2, n_cohorts=2)
    alt = rec.recommend(inter, labelled, min_score=0.0, max_share=0.5, per_user=2, n_cohorts=2,
                        assignments=labelled.select("steam_id", "cohort_id"))
    assert rows(base) == rows(alt)
    top = spark.createDataFrame([(1,), (4,)], "steam_appid long")
    named = rec.attach_item_names(top, inter, bound=2)
    assert rows(named) == [(1, "Uno"), (4, None)]          # greatest name per id; NULL kept
