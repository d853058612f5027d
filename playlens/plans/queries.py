"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
over the driver tables; ``ORACLE`` holds the equivalent DuckDB SQL.

Outputs are projected for comparison: computed doubles rounded to 6
decimals, arrays rendered as delimited strings, timestamps as epoch seconds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.functions.scalar import link_key
from playlens.operators import cohorts as coh
from playlens.operators import engagement as eng
from playlens.operators import features as feat
from playlens.operators import recommend as rec
from playlens.operators import similarity as sim
from playlens.operators.resolve import link_catalogues
from playlens.operators.topk import dedupe, latest_per_key
from playlens.plans import roles as R
from playlens.plans import sql as S
from playlens.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# --------------------------------------------------------------- engagement

@query("item_stats", f"""WITH {S.PR}
SELECT item_id, count(*) AS player_count,
       round(sum(playtime_forever), 6) AS total_playtime_forever,
       round(sum(coalesce(playtime_2weeks, 0.0)), 6) AS total_playtime_2weeks,
       round(avg(playtime_forever), 6) AS avg_playtime
FROM pr WHERE playtime_forever > 0 GROUP BY item_id""")
def q_item_stats(spark, d):
    st = eng.item_stats(R.positive_rows(spark, d), item="item_id", prefix="")
    return st.select("item_id", "player_count", r6("total_playtime_forever").alias("total_playtime_forever"),
                     r6("total_playtime_2weeks").alias("total_playtime_2weeks"),
                     r6("avg_playtime").alias("avg_playtime"))


@query("affinity", f"""WITH {S.INTER}
SELECT user_id, item_id, playtime_forever, round(global_avg_playtime, 6) AS global_avg_playtime,
       round(implicit_preference_score, 6) AS implicit_preference_score FROM inter""")
def q_affinity(spark, d):
    s = eng.score_interactions(materialize(R.purchase_rows(spark, d), "purchases"), item="item_id")
    return s.select("user_id", "item_id", "playtime_forever",
                    r6("global_avg_playtime").alias("global_avg_playtime"),
                    r6("implicit_preference_score").alias("implicit_preference_score"))


@query("library_explode", f"""WITH {S.PR},
n AS (SELECT user_id FROM pr GROUP BY user_id HAVING count(*) >= 1)
SELECT pr.user_id, pr.item_id, pr.playtime_forever FROM pr JOIN n USING (user_id)""")
def q_library_explode(spark, d):
    rows = eng.capped_library_rows(R.purchase_rows(spark, d), "user_id")
    return rows.select("user_id", "item_id", "playtime_forever")


@query("library_envelope", f"""WITH {S.PR}
SELECT user_id, count(*) AS n_items,
       string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS items,
       sum(playtime_forever) AS library_playtime
FROM pr GROUP BY user_id""")
def q_library_envelope(spark, d):
    env = eng.library_envelope(R.purchase_rows(spark, d), "user_id",
                               ["item_id", "playtime_forever"], "item_id")
    return env.select(
        "user_id", F.size("games").cast("long").alias("n_items"),
        F.array_join(F.transform("games", lambda g: g["item_id"].cast("string")), ",").alias("items"),
        F.aggregate("games", F.lit(0.0), lambda acc, g: acc + g["playtime_forever"]).alias("library_playtime"))


# --------------------------------------------------------------- resolution

_VERSIONS_SQL = """v AS (
  SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate,
         CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'initial'
              ELSE strftime(o_orderdate, '%Y%m') END AS dt
  FROM orders)"""


def _order_versions(spark, d):
    o = R.table(spark, d, "orders")
    return o.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate",
                    F.when(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("initial"))
                    .otherwise(F.date_format("o_orderdate", "yyyyMM")).alias("dt"))


@query("latest_order", f"""WITH {_VERSIONS_SQL}
SELECT o_custkey, o_orderkey, dt, o_totalprice FROM v
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN dt = 'initial' THEN 0 ELSE 1 END DESC,
                           dt DESC, o_orderdate DESC, o_orderkey DESC) = 1""")
def q_latest_order(spark, d):
    out = latest_per_key(_order_versions(spark, d), ["o_custkey"], "dt", ("initial",),
                         tie_breaks=[F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return out.select("o_custkey", "o_orderkey", "dt", "o_totalprice")


@query("latest_order_baseline", f"""WITH {_VERSIONS_SQL}
SELECT o_custkey, o_orderkey, dt, o_totalprice FROM v
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY dt DESC, o_orderdate DESC, o_orderkey DESC) = 1""")
def q_latest_order_baseline(spark, d):
    out = latest_per_key(_order_versions(spark, d), ["o_custkey"], "dt", (),
                         tie_breaks=[F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return out.select("o_custkey", "o_orderkey", "dt", "o_totalprice")


@query("dedupe_names", f"""SELECT norm_name, p_size, p_partkey, p_name FROM (
  SELECT {S.link_key_sql('p_name')} AS norm_name, p_size, p_partkey, p_name FROM part)
QUALIFY row_number() OVER (PARTITION BY norm_name, p_size ORDER BY p_partkey) = 1""")
def q_dedupe_names(spark, d):
    p = R.table(spark, d, "part").select(link_key("p_name").alias("norm_name"), "p_size", "p_partkey", "p_name")
    return dedupe(p, ["norm_name", "p_size"], [F.col("p_partkey").asc()])


def _catalogue_b_from_part(p: DataFrame) -> DataFrame:
    """Second catalogue: same titles re-cased and punctuated, some years shifted."""
    return p.select(
        (F.col("p_partkey") + F.lit(1_000_000)).alias("rawg_id"),
        link_key(F.concat(F.upper(F.regexp_replace("p_name", " ", ": ")), F.lit("!"))).alias("rawg_norm_name"),
        F.when(F.col("p_retailprice") > 1500, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("rawg_year"),
        (F.col("p_retailprice") / 100.0).alias("rawg_rating"))


_CAT_B_SQL = f"""b AS (
  SELECT p_partkey + 1000000 AS rawg_id,
         {S.link_key_sql("upper(replace(p_name, ' ', ': ')) || '!'")} AS rawg_norm_name,
         CASE WHEN p_retailprice > 1500 THEN p_size + 1 ELSE p_size END AS rawg_year,
         p_retailprice / 100.0 AS rawg_rating
  FROM part),
bd AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY rawg_norm_name, rawg_year ORDER BY rawg_id) = 1)"""


@query("link_catalogues", f"""WITH {_CAT_B_SQL}
SELECT a.p_partkey, a.norm_name, a.p_size AS release_year, bd.rawg_id,
       round(coalesce(bd.rawg_rating, 0.0), 6) AS rawg_rating
FROM (SELECT p_partkey, p_size, {S.link_key_sql('p_name')} AS norm_name FROM part) a
LEFT JOIN bd ON a.norm_name = bd.rawg_norm_name AND a.p_size = bd.rawg_year""")
def q_link_catalogues(spark, d):
    p = R.table(spark, d, "part")
    left = p.select("p_partkey", link_key("p_name").alias("norm_name"), F.col("p_size").alias("release_year"))
    out = link_catalogues(left, _catalogue_b_from_part(p), ["norm_name", "release_year"],
                          ["rawg_norm_name", "rawg_year"], [F.col("rawg_id").asc()])
    return out.select("p_partkey", "norm_name", "release_year", "rawg_id",
                      r6(F.coalesce("rawg_rating", F.lit(0.0))).alias("rawg_rating"))


# --------------------------------------------------------------- similarity

@query("tag_frequency", f"""WITH {S.ITEM_TAGS}
SELECT tag, n_items, n_items > {R.TAG_CAP} AS is_frequent FROM freq""")
def q_tag_frequency(spark, d):
    rows = sim.item_tag_rows(R.items(spark, d), "item_id", "item_name",
                             ["genre_names", "theme_names", "tag_names"])
    return sim.tag_frequency(rows).withColumn("is_frequent", F.col("n_items") > R.TAG_CAP)


def _similarity(cap, basis, k=R.NEIGHBOURS):
    def run(spark, d):
        top = sim.tag_similarity(R.items(spark, d), "item_id", "item_name",
                                 ["genre_names", "theme_names", "tag_names"],
                                 k=k, max_tag_freq=cap, size_basis=basis)
        return top.select("id", "rank", "nbr_id", "nbr_name", "shared", r6("score").alias("score"))
    return run


query("tag_similarity_all", S.similarity_sql(None, R.NEIGHBOURS, "all"))(_similarity(None, "all"))
query("tag_similarity_kept", S.similarity_sql(None, R.NEIGHBOURS, "kept"))(_similarity(None, "kept"))
query("tag_similarity_wide", S.similarity_sql(None, 2 * R.NEIGHBOURS, "all"))(_similarity(None, "all", 2 * R.NEIGHBOURS))
# cut as the reference cuts: tags of over 1,500 items are left out
query("tag_similarity_reference_cap", S.similarity_sql(R.TAG_CAP_WIDE, R.NEIGHBOURS, "all"))(
    _similarity(R.TAG_CAP_WIDE, "all"))
# a cap that bites at sf0.01
query("tag_similarity_capped", S.similarity_sql(R.TAG_CAP, R.NEIGHBOURS, "kept"))(_similarity(R.TAG_CAP, "kept"))


@query("neighbour_lists", S.similarity_sql(None, R.NEIGHBOURS, "all", f"""SELECT id,
  string_agg(nbr_id::VARCHAR, ',' ORDER BY rank) AS nbr_ids, string_agg(nbr_name, '|' ORDER BY rank) AS nbr_names
FROM ranked WHERE rank <= {R.NEIGHBOURS} GROUP BY id"""))
def q_neighbour_lists(spark, d):
    """The ordered lists."""
    top = sim.tag_similarity(R.items(spark, d), "item_id", "item_name", ["genre_names", "theme_names", "tag_names"],
                             k=R.NEIGHBOURS)
    return sim.neighbour_lists(top).select(
        "id", F.array_join(F.transform("nbr_ids", lambda x: x.cast("string")), ",").alias("nbr_ids"),
        F.array_join("nbr_names", "|").alias("nbr_names"))


# --------------------------------------------------------------- cohorts

def _inter(spark, d):
    """Interactions written once per job: every branch below reads them."""
    return materialize(R.interactions(spark, d), "interactions")


def _user_tags(spark, d, inter=None):
    inter = inter if inter is not None else R.interactions(spark, d)
    return feat.user_tag_counts(inter, "user_id", ["profile_tags"])


@query("user_tags", f"""WITH {S.USER_TAGS}
SELECT user_id, tag FROM ut""")
def q_user_tags(spark, d):
    return _user_tags(spark, d).select("user_id", "tag")


@query("tfidf", f"""WITH {S.USER_TAGS},
m AS (SELECT count(DISTINCT user_id) AS n FROM inter),
df AS (SELECT tag, count(*) AS df FROM ut GROUP BY tag HAVING count(*) >= {R.MIN_DF}),
w AS (SELECT ut.user_id, ut.tag, df.df, ln(((SELECT n FROM m) + 1.0) / (df.df + 1.0)) AS idf FROM ut JOIN df USING (tag)),
nrm AS (SELECT user_id, sqrt(sum(idf * idf)) AS norm FROM w GROUP BY user_id)
SELECT w.user_id, w.tag, w.df, round(w.idf, 6) AS idf,
       round(CASE WHEN nrm.norm > 0 THEN w.idf / nrm.norm ELSE 0.0 END, 6) AS weight
FROM w JOIN nrm USING (user_id)""")
def q_tfidf(spark, d):
    inter = _inter(spark, d)
    t = feat.tfidf(_user_tags(spark, d, inter), inter, "user_id", min_df=R.MIN_DF)
    return t.select("user_id", "tag", "df", r6("idf").alias("idf"), r6("weight").alias("weight"))


@query("tag_lift", "WITH " + S.lift_sql(R.MIN_USERS, R.MIN_SHARE) + """
SELECT cohort_id, tag, cohort_tag_users, cohort_size, global_tag_users,
       round(cohort_prop, 6) AS cohort_prop, round(global_prop, 6) AS global_prop, round(lift, 6) AS lift
FROM lift""")
def q_tag_lift(spark, d):
    inter = _inter(spark, d)
    lifts = coh.tag_lift(_user_tags(spark, d, inter), R.given_cohorts(spark, d, inter), "user_id",
                         "cohort_id")
    return lifts.select("cohort_id", "tag", "cohort_tag_users", "cohort_size", "global_tag_users",
                        r6("cohort_prop").alias("cohort_prop"), r6("global_prop").alias("global_prop"),
                        r6("lift").alias("lift"))


def _labelled(spark, d, inter, materialized: bool = False, cohorts=None, n_cohorts=None):
    """Labelled users; written once when the caller reads them several times."""
    if cohorts is None:
        cohorts = materialize(R.given_cohorts(spark, d, inter), "cohorts")   # read four times below
    lab = coh.cohort_profile(_user_tags(spark, d, inter), cohorts,
                             "user_id", "cohort_id",
                             n_cohorts=n_cohorts or R.n_given_cohorts(spark, d), min_users=R.MIN_USERS, min_share=R.MIN_SHARE)
    return materialize(lab, "labelled") if materialized else lab


@query("cohort_profile", "WITH " + S.lift_sql(R.MIN_USERS, R.MIN_SHARE) + """
SELECT user_id, cohort_id, cohort_name FROM lab""")
def q_cohort_profile(spark, d):
    return _labelled(spark, d, _inter(spark, d)).select("user_id", "cohort_id", "cohort_name")


@query("not_ubiquitous", f"""WITH {S.INTER},
pop AS (SELECT item_id, count(*) AS user_count, sum(s) AS global_score
        FROM (SELECT item_id, user_id, sum(implicit_preference_score) AS s FROM inter GROUP BY item_id, user_id)
        GROUP BY item_id)
SELECT item_id, user_count, round(global_score, 6) AS global_score FROM pop
WHERE user_count < {R.MAX_SHARE} * (SELECT count(DISTINCT user_id) FROM inter)""")
def q_not_ubiquitous(spark, d):
    inter = _inter(spark, d)
    pop = rec.not_ubiquitous(rec.item_popularity(inter, "user_id", "item_id"),
                             rec.total_users(inter, "user_id"), R.MAX_SHARE)
    return pop.select("item_id", "user_count", r6("global_score").alias("global_score"))


@query("not_ubiquitous_tight", f"""WITH {S.INTER},
pop AS (SELECT item_id, count(DISTINCT user_id) AS user_count FROM inter GROUP BY item_id)
SELECT item_id, user_count FROM pop WHERE user_count < 0.02 * (SELECT count(DISTINCT user_id) FROM inter)""")
def q_not_ubiquitous_tight(spark, d):
    """F10 with a share that bites on these tables."""
    inter = _inter(spark, d)
    return rec.not_ubiquitous(rec.item_popularity(inter, "user_id", "item_id"), rec.total_users(inter, "user_id"),
                              0.02).select("item_id", "user_count")


_SCORE_COLS = ["cohort_id", "item_id", "item_name"]


@query("cohort_scores", "WITH " + S.scores_sql(R.MIN_USERS, R.MIN_SHARE, R.MIN_SCORE, R.MAX_SHARE) + """
SELECT cohort_id, item_id, item_name, round(cohort_score, 6) AS cohort_score, user_count,
       round(global_score, 6) AS global_score, round(game_cluster_score, 6) AS game_cluster_score FROM cs""")
def q_cohort_scores(spark, d):
    inter = _inter(spark, d)
    s = rec.cohort_scores(inter, R.given_cohorts(spark, d, inter), "user_id", "item_id", "item_name",
                          cohort="cohort_id", min_score=R.MIN_SCORE, max_share=R.MAX_SHARE,
                          unique_pairs=True, repeated_labels=True)
    return s.select(*_SCORE_COLS, r6("cohort_score").alias("cohort_score"), "user_count",
                    r6("global_score").alias("global_score"),
                    r6("game_cluster_score").alias("game_cluster_score"))


@query("segment_top_items", "WITH " + S.scores_sql(R.MIN_USERS, R.MIN_SHARE, R.MIN_SCORE, R.MAX_SHARE) + """
SELECT cohort_id, cohort_rank::INTEGER AS cohort_rank, item_id, item_name,
       round(game_cluster_score, 6) AS game_cluster_score
FROM (SELECT *, row_number() OVER (PARTITION BY cohort_id ORDER BY game_cluster_score DESC, item_id ASC)
        AS cohort_rank FROM cs)
WHERE cohort_rank <= 10""")
def q_segment_top_items(spark, d):
    """Flagship: top-10 items per market segment by the cohort item score."""
    inter = _inter(spark, d)
    # purchases are one row per user and item; users without any score nothing
    s = rec.cohort_scores(inter, R.segments(spark, d), "user_id", "item_id", "item_name", cohort="cohort_id",
                          min_score=R.MIN_SCORE, max_share=R.MAX_SHARE, with_names=False, unique_pairs=True)
    top = rec.cohort_top_items(s, "item_id", "cohort_id", 10)
    top = rec.attach_item_names(top, inter, "item_id", "item_name", R.n_given_cohorts(spark, d) * 10)
    return top.select("cohort_id", "cohort_rank", "item_id", "item_name",
                      r6("game_cluster_score").alias("game_cluster_score"))


def _recommend(spark, d):
    inter = _inter(spark, d)
    n_cohorts = R.n_given_cohorts(spark, d)
    labelled = _labelled(spark, d, inter, materialized=True, n_cohorts=n_cohorts)
    return rec.recommend(inter, labelled, None, "user_id", "item_id", "item_name",
                         cohort="cohort_id", min_score=R.MIN_SCORE, max_share=R.MAX_SHARE,
                         per_cohort=R.PER_COHORT, per_user=R.PER_USER, n_cohorts=n_cohorts, unique_pairs=True)


@query("recommend", "WITH " + S.reco_sql(R.MIN_USERS, R.MIN_SHARE, R.MIN_SCORE, R.MAX_SHARE, R.PER_COHORT,
                               R.PER_USER) + """
SELECT user_id, cohort_id, cohort_name, reco_rank::INTEGER AS reco_rank, item_id, item_name,
       round(game_cluster_score, 6) AS game_cluster_score FROM ranked""")
def q_recommend(spark, d):
    return _recommend(spark, d).select("user_id", "cohort_id", "cohort_name", "reco_rank", "item_id",
                                       "item_name", r6("game_cluster_score").alias("game_cluster_score"))


@query("recommendation_scores", "WITH " + S.reco_sql(R.MIN_USERS, R.MIN_SHARE, R.MIN_SCORE, R.MAX_SHARE, R.PER_COHORT,
                                           R.PER_USER) + """
SELECT user_id, reco_rank::INTEGER - 1 AS place, item_id AS recommended_id, item_name AS recommended_game,
       abs(round(game_cluster_score, 2) - game_cluster_score) <= 0.005 + 1e-9 AS rounded
FROM ranked""")
def q_recommendation_scores(spark, d):
    """The parallel lists, read back place by place; scores are
    rounded to two decimals (checked against the ranked rows, not by digits,
    where sums in another order may fall on the other side of a half)."""
    ranked = materialize(_recommend(spark, d), "ranked")   # packed, and looked up again
    packed = rec.pack_recommendations(ranked, "user_id", "item_id", "cohort_id")
    flat = packed.select("user_id", F.posexplode(F.arrays_zip(
        F.col("recommended_ids").alias("i"), F.col("recommended_games").alias("g"),
        F.col("recommendation_scores").alias("s"))).alias("place", "x"))
    full = ranked.select(F.col("user_id").alias("u"), F.col("item_id").alias("it"), "game_cluster_score")
    return flat.join(full, (F.col("user_id") == F.col("u")) & (F.col("x.i") == F.col("it"))).select(
        "user_id", "place", F.col("x.i").alias("recommended_id"), F.col("x.g").alias("recommended_game"),
        (F.abs(F.col("x.s") - F.col("game_cluster_score")) <= 0.005 + 1e-9).alias("rounded"))


@query("recommend_packed", "WITH " + S.reco_sql(R.MIN_USERS, R.MIN_SHARE, R.MIN_SCORE, R.MAX_SHARE, R.PER_COHORT,
                                      R.PER_USER) + """
SELECT user_id, cohort_id, cohort_name,
       string_agg(item_id::VARCHAR, ',' ORDER BY reco_rank) AS recommended_ids,
       string_agg(item_name, '|' ORDER BY reco_rank) AS recommended_games,
       count(*) AS n_recommended
FROM ranked GROUP BY user_id, cohort_id, cohort_name""")
def q_recommend_packed(spark, d):
    packed = rec.pack_recommendations(_recommend(spark, d), "user_id", "item_id", "cohort_id")
    return packed.select(
        "user_id", "cohort_id", "cohort_name",
        F.array_join(F.transform("recommended_ids", lambda x: x.cast("string")), ",").alias("recommended_ids"),
        F.array_join("recommended_games", "|").alias("recommended_games"),
        F.size("recommended_ids").cast("long").alias("n_recommended"))
