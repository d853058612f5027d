import pytest
import math

from pyspark.sql import functions as F

from playlens.functions.nested import arr_or_empty, fill_defaults, first_where, pluck, pluck_where
from playlens.functions.scalar import (affinity, cohort_item_score, epoch_ts, jaccard, link_key, release_year,
                                       safe_cast, safe_date, safe_ts, slug, unify_tags)


def test_epoch_round_trip_across_dst(spark):
    epochs = list(range(1698537600, 1698548400 + 1, 1800))  # a DST fall-back night in Europe
    df = spark.createDataFrame([(e,) for e in epochs], "e long")
    out = df.select(F.unix_timestamp(epoch_ts("e")).alias("back")).collect()
    assert [r.back for r in out] == epochs


def test_new_year_in_utc(spark):
    df = spark.createDataFrame([(1704065400,)], "e long")
    assert df.select(release_year(epoch_ts("e"))).first()[0] == 2023


def test_lenient_dates_and_times(spark):
    df = spark.createDataFrame([("2024-02-30",), ("",), (None,), ("2024-02-28",)], "s string")
    got = [r[0] for r in df.select(safe_date("s")).collect()]
    assert got[:3] == [None, None, None] and str(got[3]) == "2024-02-28"
    ts = [r[0] for r in df.select(safe_ts("s")).collect()]
    assert ts[:3] == [None, None, None]
    assert spark.createDataFrame([("x1",), ("12",)], "s string").select(safe_cast("s", "long")).collect() == [
        (None,), (12,)]


def test_link_key(spark):
    df = spark.createDataFrame([("Foo: Bar!",), ("FOO BAR",), ("ゼルダ",), (None,)], "n string")
    got = [r[0] for r in df.select(link_key("n")).collect()]
    assert got == ["foobar", "foobar", None, None]
    assert df.select(link_key("n", empty_as_null=False)).collect()[2][0] == ""


def test_slug(spark):
    df = spark.createDataFrame([("Co-op",), ("co op",), ("Role-playing (RPG)",)], "t string")
    assert [r[0] for r in df.select(slug("t")).collect()] == ["co_op", "co_op", "role_playing_rpg_"]


def test_scores(spark):
    df = spark.createDataFrame([(10.0, 20.0, 3, 3, 3)], "x double, a double, i long, na long, nb long")
    r = df.select(affinity("x", "a"), jaccard("i", "na", "nb"), cohort_item_score(F.lit(11.0), F.lit(3.0)),
                  affinity("x", F.lit(0.0)), jaccard(F.lit(0), F.lit(0), F.lit(0))).first()
    assert math.isclose(r[0], math.log1p(0.5))
    assert r[1] == 1.0
    assert math.isclose(r[2], 11.0 ** 1.2 / math.log1p(3.0))
    assert r[3] is None and r[4] is None


def test_unify_tags_handles_nulls(spark):
    df = spark.createDataFrame([(["a", "b"], None, ["b", "c"])], "x array<string>, y array<string>, z array<string>")
    assert df.select(unify_tags("x", "y", "z")).first()[0] == ["a", "b", "c"]


NESTED = ("id long, arr array<struct<name:string, flag:boolean, sub:struct<name:string>>>, "
          "ext array<struct<uid:string, src:struct<name:string>>>")


def test_nested_access(spark):
    df = spark.createDataFrame([
        (1, None, None),
        (2, [], []),
        (3, [("a", True, ("x",)), (None, False, None)], [("abc", ("Steam",))]),
        (4, [("b", None, ("y",))], [("7", ("Other",)), ("42", ("Steam",)), ("43", ("Steam",))]),
    ], NESTED)
    out = df.select(
        "id", pluck("arr", "name").alias("names"), pluck("arr", "sub.name").alias("subs"),
        pluck_where("arr", lambda x: x["flag"] == F.lit(True), "name").alias("flagged"),
        first_where("ext", lambda x: x["src"]["name"] == F.lit("Steam"), "uid", cast="long").alias("app"),
    ).orderBy("id").collect()
    assert out[0].names is None and out[0].app is None
    assert out[1].names == [] and out[1].flagged == [] and out[1].app is None
    assert out[2].names == ["a", None] and out[2].subs == ["x", None] and out[2].flagged == ["a"]
    assert out[2].app is None            # malformed uid -> NULL, not an error
    assert out[3].flagged == [] and out[3].app == 42   # first matching element


def test_fill_defaults_skips_unknown(spark):
    df = spark.createDataFrame([(None, None)], "a int, b string")
    r = fill_defaults(df, {"a": 0, "b": "", "missing": 1}).first()
    assert (r.a, r.b) == (0, "")
    assert spark.createDataFrame([(None,)], "x array<string>").select(arr_or_empty("x")).first()[0] == []


def test_select_as_and_daily_path(spark):
    from playlens.functions.nested import select_as
    from playlens.sources.readers import daily_path

    df = spark.createDataFrame([("7", "x", 1.5)], "a string, b string, c double")
    out = select_as(df, {"id": ("a", "long"), "name": "b", "bad": ("b", "int"), "score": F.col("c") * 2})
    assert out.columns == ["id", "name", "bad", "score"] and tuple(out.first()) == (7, "x", None, 3.0)
    assert daily_path("/raw/daily_{date}.json", "20240102") == "/raw/daily_20240102.json"


def test_cluster_conf_scales_with_input():
    from playlens.session import cluster_conf

    big = cluster_conf(100 * 2**40, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    small = cluster_conf(10 * 2**20, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24


def test_checkpoint_root_reads_session_then_falls_back():
    from playlens.session import checkpoint_root

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

        def set(self, key, value):
            self.value = value

    class Ctx:
        master = "local[4]"

        def __init__(self):
            self.dir = None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class Session:
        def __init__(self, value):
            self.conf, self.sparkContext = Conf(value), Ctx()

    shared = Session("hdfs://cluster/checkpoints/")
    assert checkpoint_root(shared) == "hdfs://cluster/checkpoints"      # the cluster's folder is used
    assert shared.sparkContext.dir == "hdfs://cluster/checkpoints/"
    local = Session(None)
    root = checkpoint_root(local)                                         # unset: a private folder (tests)
    assert local.conf.value == root and local.sparkContext.dir == root
    cluster = Session(None)
    cluster.sparkContext.master = "local-cluster[3,2,1024]"               # executors of their own: never a private folder
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(cluster)
