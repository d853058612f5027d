from pyspark.sql import functions as F

from playlens.operators import similarity as sim
from tests.conftest import plan_text

ITEMS = "igdb_id long, igdb_name string, genre_names array<string>, theme_names array<string>, tag_names array<string>"


def _items(spark, data):
    return spark.createDataFrame(data, ITEMS)


def test_twins_are_keyed_by_id(spark):
    df = _items(spark, [(1, "A", ["x", "y", "z"], None, None), (2, "Dup", ["x", "y", "z"], None, None),
                        (3, "Dup", ["x"], ["y"], ["z"])])
    top = sim.tag_similarity(df, k=10, max_tag_freq=1500)
    got = sorted((r.id, r.nbr_id, r.score) for r in top.collect())
    assert got == [(1, 2, 1.0), (1, 3, 1.0), (2, 1, 1.0), (2, 3, 1.0), (3, 1, 1.0), (3, 2, 1.0)]
    # rank order inside one item: score desc, name asc, id asc
    r1 = [r.nbr_id for r in top.filter("id = 1").orderBy("rank").collect()]
    assert r1 == [2, 3]


def test_frequent_tag_and_size_basis(spark):
    data = [(i, f"n{i}", ["common"], ["t{}".format(i % 2)], None) for i in range(1, 5)]
    df = _items(spark, data)
    allb = {(r.id, r.nbr_id): r for r in sim.tag_similarity(df, k=10, max_tag_freq=3).collect()}
    # 'common' (4 items) is above the cap: only the t0/t1 tag is shared
    assert set(allb) == {(1, 3), (3, 1), (2, 4), (4, 2)}
    assert allb[(1, 3)].shared == 1 and allb[(1, 3)].score == 1 / 3      # sizes include 'common'
    kept = {(r.id, r.nbr_id): r.score for r in sim.tag_similarity(df, k=10, max_tag_freq=3,
                                                                  size_basis="kept").collect()}
    assert kept[(1, 3)] == 1.0


def test_no_tags_gives_empty_list_and_properties(spark):
    df = _items(spark, [(1, "a", ["x", "y"], None, None), (2, "b", ["x"], None, None), (3, "c", None, None, None),
                        (4, "d", ["y", "z"], ["x"], None)])
    top = sim.tag_similarity(df, k=1, max_tag_freq=100)
    assert top.groupBy("id").count().filter("count > 1").count() == 0         # top-k <= k
    full = sim.tag_similarity(df, k=10, max_tag_freq=100)
    pairs = {(r.id, r.nbr_id): r.score for r in full.collect()}
    assert all(0 <= s <= 1 for s in pairs.values())
    assert all(pairs[(b, a)] == s for (a, b), s in pairs.items())            # symmetric
    cat = sim.compute_similar_games(df.withColumn("similar_game_names", F.lit(None).cast("array<string>")))
    got = {r.igdb_id: r for r in cat.collect()}
    assert got[3].computed_similar_games == [] and got[3].similar_game_names == []
    plan = plan_text(full)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_cap_that_leaves_no_tag_gives_no_rows(spark):
    df = _items(spark, [(i, f"n{i}", ["common"], None, None) for i in range(1, 5)])
    for basis in ("all", "kept"):
        top = sim.tag_similarity(df, k=2, max_tag_freq=3, size_basis=basis)
        assert top.columns == ["id", "rank", "nbr_id", "nbr_name", "shared", "score"] and top.count() == 0
    assert sim.tag_similarity(df, k=2, max_tag_freq=4).count() == 8
