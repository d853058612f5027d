from playlens.operators import engagement as eng


def test_tags_of_all_rows_of_a_key(spark):
    inter = spark.createDataFrame([("u", 5), ("u", 6), ("v", 7), ("v", 8), ("w", None)], "steam_id string, steam_appid long")
    items = spark.createDataFrame(
        [(1, 5, ["x", "w"], "a"), (2, 5, ["y", "x"], "b"), (3, 6, ["q", "b"], "c"), (4, 7, None, "d"), (5, 7, ["z"], "e"),
         (6, None, ["n"], "f")],
        "igdb_id long, steam_appid long, tags array<string>, name string")
    got = eng.enrich(inter, items, "steam_appid", ["tags", "name"], order_by=["igdb_id"], union=["tags"])
    assert sorted(((r.steam_appid, r.tags, r.name) for r in got.collect()), key=repr) == sorted(
        [(5, ["w", "x", "y"], "a"), (6, ["q", "b"], "c"), (7, ["z"], "d"), (8, None, None), (None, None, None)], key=repr)
