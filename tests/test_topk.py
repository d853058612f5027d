from pyspark.sql import functions as F

from playlens.operators.topk import dedupe, latest_per_key, top_k
from tests.conftest import plan_text, rows

SCHEMA = "id long, dt string, updated_at long, v string"


def test_latest_prefers_daily_over_initial(spark):
    df = spark.createDataFrame([(1, "initial", 5, "bulk"), (1, "20240101", 1, "d1"), (1, "20240102", 1, "d2")],
                               SCHEMA)
    assert rows(latest_per_key(df, ["id"]), "v") == [("d2",)]
    # plain text order: 'initial' > any date, as in the reference
    assert rows(latest_per_key(df, ["id"], baseline_labels=()), "v") == [("bulk",)]


def test_same_load_duplicate_keeps_newest(spark):
    df = spark.createDataFrame([(1, "20240101", 1, "old"), (1, "20240101", 9, "new")], SCHEMA)
    out = latest_per_key(df, ["id"], tie_breaks=[F.col("updated_at").desc()])
    assert rows(out, "v") == [("new",)]


def test_top_k_ties_break_on_id_and_plan_has_group_limit(spark):
    df = spark.createDataFrame([(1, 5.0, 3), (1, 5.0, 2), (1, 5.0, 1), (1, 1.0, 0), (2, 1.0, 9)],
                               "g long, s double, item long")
    out = top_k(df, "g", [F.col("s").desc(), F.col("item").asc()], 2)
    assert rows(out, "g", "item", "rank") == [(1, 1, 1), (1, 2, 2), (2, 9, 1)]
    assert "WindowGroupLimit" in plan_text(out)


def test_dedupe_null_keys_group_together(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, id long")
    assert rows(dedupe(df, ["k"], [F.col("id").asc()]), "id") == [(1,), (3,)]


def test_pages_numbering_and_cap(spark):
    from playlens.operators.resolve import page, pages

    df = spark.createDataFrame([(i, float(i % 7)) for i in range(100)], "id long, v double")
    order = [F.col("v").desc(), F.col("id").asc()]
    out = pages(df, order, page_size=10, max_pages=3)
    got = rows(out, "page")
    assert len(got) == 30 and got[0] == (1,) and got[-1] == (3,)
    second = rows(page(df, order, limit=10, offset=10), "id")
    assert second == rows(out.filter("page = 2"), "id")


def test_dated_loads_alone_read_as_text(spark, tmp_path):
    from pyspark.sql import functions as F

    from playlens.operators.resolve import as_of_filter
    from playlens.operators.topk import latest_per_key
    from playlens.sources.readers import read_silver

    root = str(tmp_path / "silver")
    rows = [(1, "old", "20240101"), (1, "new", "20240102"), (2, "only", "20240101")]
    spark.createDataFrame(rows, "id long, v string, dt string").write.partitionBy("dt").parquet(root)
    df = read_silver(spark, root)
    assert df.schema["dt"].dataType.simpleString() == "string"
    assert sorted(r["v"] for r in latest_per_key(df, ["id"]).collect()) == ["new", "only"]
    inferred = spark.read.parquet(root)  # dt is a number here
    assert sorted(r["v"] for r in latest_per_key(inferred, ["id"]).collect()) == ["new", "only"]
    assert sorted(r["v"] for r in as_of_filter(inferred, "dt", "20240101").select(F.col("v")).collect()) == ["old", "only"]


def test_pages_reach_the_end(spark):
    from pyspark.sql import functions as F

    from playlens.operators.resolve import pages

    got = pages(spark.range(205), [F.col("id").desc()], page_size=10).collect()
    assert sorted((r["id"], r["page"]) for r in got) == [(i, (204 - i) // 10 + 1) for i in range(205)]
