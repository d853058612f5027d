import math

from pyspark.sql import functions as F

from playlens.operators import engagement as eng
from tests.conftest import rows

LIB = "steam_id string, games array<struct<appid:long, name:string, playtime_forever:long, playtime_2weeks:long>>"


def _games(n):
    return [(i, f"g{i}", 1, None) for i in range(n)]


def test_valid_libraries_bounds(spark):
    df = spark.createDataFrame([(None, _games(1)), ("nulllist", None), ("zero", []), ("one", _games(1)),
                                ("full", _games(500)), ("over", _games(501))], LIB)
    assert rows(eng.valid_libraries(df, max_items=500), "steam_id") == [("full",), ("one",)]
    assert rows(eng.valid_libraries(df), "steam_id") == [("full",), ("one",), ("over",)]   # no bound by default


def test_capped_rows_match_list_filter(spark):
    flat = spark.createDataFrame([(u, i) for u, n in (("a", 2), ("b", 4), ("c", 1)) for i in range(n)],
                                 "user string, item long")
    assert rows(eng.capped_library_rows(flat, "user", max_items=2), "user") == [("a",), ("a",), ("c",)]
    env = eng.library_envelope(flat, "user", ["item"], "item", max_items=2)
    got = {r.user: [g.item for g in r.games] for r in env.collect()}
    assert got == {"a": [0, 1], "c": [0]}


def test_affinity_against_item_average(spark):
    df = spark.createDataFrame([("u1", 7, 10.0), ("u2", 7, 20.0), ("u3", 7, 30.0), ("u4", 7, 0.0)],
                               "steam_id string, steam_appid long, playtime_forever double")
    out = {r.steam_id: r for r in eng.score_interactions(df).collect()}
    assert "u4" not in out                      # zero playtime is not an interaction
    assert out["u1"].global_avg_playtime == 20.0
    for u, x in (("u1", 1.5), ("u2", 2.0), ("u3", 2.5)):
        assert math.isclose(out[u].implicit_preference_score, math.log(x))


def test_enrich_never_duplicates(spark):
    inter = spark.createDataFrame([("u", 5, 1.0)], "steam_id string, steam_appid long, s double")
    items = spark.createDataFrame([(1, 5, ["x"]), (2, 5, ["y"])], "igdb_id long, steam_appid long, tags array<string>")
    one = eng.enrich(inter, items, "steam_appid", ["tags"], order_by=[F.col("igdb_id")])
    assert one.count() == 1 and one.first().tags == ["x"]
    fan = eng.enrich(inter, items, "steam_appid", ["tags"], allow_fanout=True)
    assert fan.count() == 2


def test_item_stats_and_attach(spark):
    inter = spark.createDataFrame([(5, 10.0, None), (5, 30.0, 2.0)],
                                  "steam_appid long, playtime_forever double, playtime_2weeks double")
    st = eng.item_stats(inter).first()
    assert (st.steam_player_count, st.steam_total_playtime_forever, st.steam_total_playtime_2weeks,
            st.steam_avg_playtime) == (2, 40.0, 2.0, 20.0)
    items = spark.createDataFrame([(5,), (6,)], "steam_appid long")
    out = {r.steam_appid: r for r in eng.attach_stats(items, eng.item_stats(inter), "steam_appid",
                                                      "steam_appid").collect()}
    assert out[6].steam_player_count == 0 and out[6].steam_avg_playtime == 0.0


def test_left_join_nonnull_keys(spark):
    from playlens.operators.joins import left_join_nonnull_keys

    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (None, "d")], "k long, v string")
    right = spark.createDataFrame([(1, 10), (None, 99), (3, 30)], "rk long, x long")
    out = left_join_nonnull_keys(left, right, ["k"], ["rk"])
    assert rows(out, "v", "x") == [("a", 10), ("b", None), ("c", None), ("d", None)]
    assert out.columns == ["k", "v", "rk", "x"]
