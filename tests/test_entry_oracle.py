import duckdb
import pytest

from tests.conftest import SF_SMALL

import __spark_entry__ as entry_mod
from playlens.plans.registry import ORACLE, QUERIES


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["cohort_id", "cohort_rank", "item_id", "item_name", "game_cluster_score"]
    assert df.count() == 50


def test_registry_keys():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    q, o = QUERIES, ORACLE
    assert set(q) <= set(entry_mod.queries()) and set(o) <= set(entry_mod.oracle_sql())
    assert set(q) - set(o) == {"cohorts_kmeans", "cohort_quality", "learned_cohort_profile", "learned_recommend"}


@pytest.fixture(scope="module")
def duck():
    from playlens.plans.roles import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


SAME_TYPE = {("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"), ("string", "VARCHAR"),
             ("boolean", "BOOLEAN"), ("float", "FLOAT"), ("date", "DATE")}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _check_plan(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan], plan


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    from tools.oracle_check import rows_of

    df = entry_mod.queries()[name](spark, SF_SMALL)
    sp = df.toPandas()
    _check_plan(df)
    rel = duck.execute(entry_mod.oracle_sql()[name])
    duck_types = {d[0]: str(d[1]) for d in rel.description}
    dk = rel.df()
    for f in df.schema.fields:                       # same column types on both sides
        assert (f.dataType.simpleString(), duck_types[f.name]) in SAME_TYPE, (f.name, duck_types[f.name])
    c1, r1 = rows_of(sp)
    c2, r2 = rows_of(dk)
    assert c1 == c2
    assert r1 == r2


@pytest.mark.parametrize("name", ["cohorts_kmeans", "learned_cohort_profile"])
def test_rows_only_queries(spark, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    n = df.count()
    _check_plan(df)
    users = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_custkey").distinct().count()
    assert n == users      # one cohort row per user with interactions


def test_filters_and_columns_reach_the_scan(spark):
    df = entry_mod.queries()["changed_since"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), IsNotNull(value), GreaterThan(ts" in plan
    assert "GreaterThan(value,10.0)" in plan
    assert "props" not in plan                       # unused column never read
    stats = entry_mod.queries()["item_stats"](spark, SF_SMALL)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_linestatus:string>" in plan
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan
