"""Registered queries, part 2: formatting, master catalogue, parsing, delta
filters, paging, upsert and documents, frontier expansion, streaming loads,
reports and learned cohorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from playlens.functions.scalar import epoch_ts, safe_cast, safe_date, safe_ts
from playlens.session import materialize
from playlens.operators import cohorts as coh
from playlens.operators import features as feat
from playlens.operators import frontier as fr
from playlens.operators import recommend as rec
from playlens.operators import reports as rep
from playlens.operators import similarity as sim
from playlens.operators.engagement import item_stats
from playlens.operators.resolve import changed_between, changed_since, eligible, master_catalogue, page
from playlens.operators.upsert import upsert
from playlens.plans import catalogues as C
from playlens.plans import roles as R
from playlens.plans import sql as S
from playlens.plans.queries import _inter, _labelled, _recommend, _user_tags, query, r6
from playlens.session import scratch_path
from playlens.sources.sinks import to_documents
from playlens.streaming.loads import load_batches


def _join_arr(c):
    return F.array_join(c, ",")


def _dbl6(c):
    return r6(F.col(c).cast("double")).alias(c)


# --------------------------------------------------------------- formatting

_A_FRESH_SQL = """SELECT p_partkey AS id, p_name AS name, lower(replace(p_name, ' ', '-')) AS slug,
  CASE WHEN p_size % 3 = 0 THEN '' ELSE 'About ' || p_name END AS summary,
  '' AS storyline,
  946684800::BIGINT + p_size::BIGINT * 31536000 + p_partkey AS release_epoch,
  1700000000::BIGINT + p_partkey AS updated_epoch,
  replace(p_name, ' ', ',') AS genre_names, p_brand AS theme_names, 'Single player' AS game_mode_names,
  p_type AS platform_names, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_brand END AS keyword_names,
  CASE WHEN p_size % 2 = 0 THEN p_brand || ',' ELSE '' END || 'Maker#' || p_size AS developers,
  CASE WHEN p_size % 3 = 0 THEN p_brand ELSE '' END AS publishers,
  CAST(CAST(p_retailprice / 20.0 AS FLOAT) AS DOUBLE) AS rating_d,
  p_size AS rating_count,
  round(CAST(CAST(p_retailprice / 22.0 AS FLOAT) AS DOUBLE), 6) AS total_rating,
  p_size + 2 AS total_rating_count,
  round(CAST(CAST(p_retailprice / 25.0 AS FLOAT) AS DOUBLE), 6) AS aggregated_rating,
  p_size + 1 AS aggregated_rating_count,
  p_size AS hypes, CASE WHEN p_size > 45 THEN 0 ELSE p_size * 10 END AS follows,
  p_type AS collection_name, '' AS franchise_names, p_name AS similar_game_names,
  CASE WHEN p_partkey % 10 = 0 OR p_partkey % 3 = 0 THEN NULL ELSE p_partkey END AS steam_appid,
  p_size
FROM part WHERE p_size <> 50"""


@query("format_catalogue_a", f"""SELECT * EXCLUDE (rating_d, p_size), round(rating_d, 6) AS rating
FROM ({_A_FRESH_SQL})""")
def q_format_catalogue_a(spark, d):
    from playlens.operators.formatting import format_catalogue_a

    f = format_catalogue_a(C.raw_catalogue_a(spark, d))
    return f.select(
        "id", "name", "slug", "summary", "storyline",
        F.unix_timestamp("release_date").alias("release_epoch"),
        F.unix_timestamp("updated_at").alias("updated_epoch"),
        *[_join_arr(c).alias(c) for c in ("genre_names", "theme_names", "game_mode_names", "platform_names",
                                          "keyword_names", "developers", "publishers")],
        _dbl6("rating"), "rating_count", _dbl6("total_rating"), "total_rating_count",
        _dbl6("aggregated_rating"), "aggregated_rating_count", "hypes", "follows", "collection_name",
        _join_arr("franchise_names").alias("franchise_names"),
        _join_arr("similar_game_names").alias("similar_game_names"), "steam_appid")


_B_SQL = """WITH f AS (
  SELECT *, (2000 + p_size % 25)::VARCHAR AS yr, (p_partkey % 11 = 0 AND p_size <= 5) AS stale_wins FROM part)
SELECT p_partkey + 1000000 AS id, upper(replace(p_name, ' ', ': ')) || '!' AS name,
  lower(replace(p_name, ' ', '-')) AS slug,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE yr || '-01-15' END AS release_date,
  CASE WHEN stale_wins THEN 915148800
       WHEN p_partkey % 11 = 0 THEN NULL
       ELSE epoch(CAST(yr || '-06-01 10:00:00' AS TIMESTAMP))::BIGINT END AS updated_epoch,
  CASE WHEN stale_wins THEN 0.0 ELSE round(CAST(CAST(p_retailprice / 400.0 AS FLOAT) AS DOUBLE), 6) END AS rating,
  CASE WHEN p_size > 40 THEN 0 ELSE p_size + 50 END AS metacritic,
  p_size AS playtime, p_size * 10 AS total_added, p_size * 3 AS ratings_count, p_size AS reviews_count,
  p_size * 2 AS status_owned, p_size AS status_beaten, p_size % 4 AS status_dropped,
  CASE WHEN p_size % 2 = 1 THEN 0 ELSE 3 END AS status_toplay,
  replace(p_name, ' ', ',') AS genre_names, p_type AS platform_names,
  'Store#' || (p_size % 3) AS store_names, p_brand AS tag_names,
  CASE WHEN p_size % 2 = 0 THEN 'Teen' END AS esrb_rating_name
FROM f"""


@query("format_catalogue_b", _B_SQL)
def q_format_catalogue_b(spark, d):
    from playlens.operators.formatting import format_catalogue_b

    f = format_catalogue_b(C.raw_catalogue_b(spark, d))
    return f.select(
        "id", "name", "slug", F.date_format("release_date", "yyyy-MM-dd").alias("release_date"),
        F.unix_timestamp("updated_at").alias("updated_epoch"), _dbl6("rating"), "metacritic", "playtime",
        "total_added", "ratings_count", "reviews_count", "status_owned", "status_beaten", "status_dropped",
        "status_toplay", *[_join_arr(c).alias(c) for c in ("genre_names", "platform_names", "store_names",
                                                             "tag_names")],
        "esrb_rating_name")


@query("eligible", """WITH raw AS (
  SELECT CASE WHEN p_size = 50 THEN NULL ELSE p_partkey END AS id, p_name AS name, p_size % 10 AS game_type,
         p_partkey FROM part
  UNION ALL SELECT p_partkey, p_name, p_size % 10, p_partkey FROM part WHERE p_size <= 5)
SELECT id, name, game_type FROM raw WHERE game_type IN (0, 4, 8, 9) AND p_partkey % 3 <> 0""")
def q_eligible(spark, d):
    out = eligible(C.raw_catalogue_a(spark, d), "game_type", [0, 4, 8, 9], "external_games",
                   lambda x: x["external_game_source"]["name"] == F.lit("Steam"))
    return out.select("id", "name", "game_type")


# --------------------------------------------------------------- master

_MASTER_SQL = f"""WITH {S.PR},
st AS (SELECT item_id, count(*) AS steam_player_count, sum(playtime_forever) AS tpf,
              sum(coalesce(playtime_2weeks, 0.0)) AS tp2, avg(playtime_forever) AS apt
       FROM pr WHERE playtime_forever > 0 GROUP BY item_id),
a AS (SELECT id AS igdb_id, name AS igdb_name,
             year(make_timestamp(release_epoch * 1000000))::INTEGER AS release_year,
             {S.link_key_sql('name')} AS norm_name,
             CASE WHEN p_size > 40 THEN CAST(CAST(rating_d AS FLOAT) * 2 AS DOUBLE) ELSE rating_d END AS igdb_rating,
             steam_appid
      FROM ({_A_FRESH_SQL})),
b AS (SELECT p_partkey + 1000000 AS rawg_id,
             {S.link_key_sql("upper(replace(p_name, ' ', ': ')) || '!'")} AS rawg_norm_name,
             CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE (2000 + p_size % 25)::INTEGER END AS rawg_release_year,
             CASE WHEN p_partkey % 11 = 0 AND p_size <= 5 THEN 0.0
                  ELSE CAST(CAST(p_retailprice / 400.0 AS FLOAT) AS DOUBLE) END AS rawg_rating,
             CASE WHEN p_size > 40 THEN 0 ELSE p_size + 50 END AS rawg_metacritic,
             p_size * 2 AS rawg_status_owned
      FROM part),
bd AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY rawg_norm_name, rawg_release_year
                                                  ORDER BY rawg_id) = 1)
SELECT a.igdb_id, a.igdb_name, a.release_year, a.norm_name, round(a.igdb_rating, 6) AS igdb_rating,
       bd.rawg_id, round(coalesce(bd.rawg_rating, 0.0), 6) AS rawg_rating,
       coalesce(bd.rawg_metacritic, 0) AS rawg_metacritic, coalesce(bd.rawg_status_owned, 0) AS rawg_status_owned,
       coalesce(st.steam_player_count, 0) AS steam_player_count,
       round(coalesce(st.tpf, 0.0), 6) AS steam_total_playtime_forever,
       round(coalesce(st.tp2, 0.0), 6) AS steam_total_playtime_2weeks,
       round(coalesce(st.apt, 0.0), 6) AS steam_avg_playtime
FROM a LEFT JOIN bd ON a.norm_name = bd.rawg_norm_name AND a.release_year = bd.rawg_release_year
LEFT JOIN st ON a.steam_appid = st.item_id"""


def _master(spark, d):
    stats = item_stats(R.positive_rows(spark, d), item="item_id", prefix="steam_")
    stats = stats.withColumnRenamed("item_id", "steam_appid")
    return master_catalogue(C.silver_a(spark, d), C.silver_b(spark, d), stats)


_MASTER_COLS = ["igdb_id", "igdb_name", "release_year", "norm_name"]


@query("master", _MASTER_SQL)
def q_master(spark, d):
    m = _master(spark, d)
    return m.select(*_MASTER_COLS, _dbl6("igdb_rating"), "rawg_id", _dbl6("rawg_rating"), "rawg_metacritic",
                    "rawg_status_owned", "steam_player_count", _dbl6("steam_total_playtime_forever"),
                    _dbl6("steam_total_playtime_2weeks"), _dbl6("steam_avg_playtime"))


@query("report_ratings", f"""SELECT igdb_id, igdb_name, release_year, igdb_rating, rawg_rating, rawg_metacritic,
       steam_player_count, round(abs(igdb_rating / 20.0 - rawg_rating), 6) AS rating_gap
FROM ({_MASTER_SQL})""")
def q_report_ratings(spark, d):
    r = rep.report_ratings(_master(spark, d))
    return r.select("igdb_id", "igdb_name", "release_year", _dbl6("igdb_rating"), _dbl6("rawg_rating"),
                    "rawg_metacritic", "steam_player_count", _dbl6("rating_gap"))


# --------------------------------------------------------------- parsing, deltas, paging

@query("safe_parse", """SELECT event_id,
  strftime(TRY_CAST(CASE WHEN event_id % 10 = 0 THEN '2024-02-30' ELSE strftime(ts, '%Y-%m-%d') END AS DATE),
           '%Y-%m-%d') AS parsed_date,
  CAST(floor(epoch(TRY_CAST(CASE WHEN event_id % 10 = 5 THEN 'not a time'
                                 ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP))) AS BIGINT) AS parsed_epoch,
  TRY_CAST(CASE WHEN event_id % 10 = 3 THEN 'x' || event_id ELSE event_id::VARCHAR END AS BIGINT) AS parsed_id,
  year(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000))::INTEGER AS epoch_year
FROM events""")
def q_safe_parse(spark, d):
    e = R.table(spark, d, "events")
    date_text = F.when(F.col("event_id") % 10 == 0, F.lit("2024-02-30")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    ts_text = (F.when(F.col("event_id") % 10 == 5, F.lit("not a time"))
               .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    id_text = (F.when(F.col("event_id") % 10 == 3, F.concat(F.lit("x"), F.col("event_id").cast("string")))
               .otherwise(F.col("event_id").cast("string")))
    epoch = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return e.select(
        "event_id",
        F.date_format(safe_date(date_text), "yyyy-MM-dd").alias("parsed_date"),
        F.unix_timestamp(safe_ts(ts_text)).alias("parsed_epoch"),
        safe_cast(id_text, "long").alias("parsed_id"),
        F.year(epoch_ts(epoch)).alias("epoch_year"))


@query("changed_since", """SELECT event_id, user_id, event_type, value FROM events
WHERE ts > TIMESTAMP '2024-01-04 00:00:00' AND value > 10""")
def q_changed_since(spark, d):
    e = changed_since(R.table(spark, d, "events"), "ts", "2024-01-05", days=1, min_col="value", min_value=10)
    return e.select("event_id", "user_id", "event_type", "value")


@query("changed_between", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01 00:00:00' AND TIMESTAMP '1998-12-31 00:00:00'""")
def q_changed_between(spark, d):
    o = R.table(spark, d, "orders")
    lo = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit("1998-12-31 00:00:00").cast("timestamp_ntz")
    return changed_between(o, "o_orderdate", lo, hi).select("o_orderkey", "o_custkey", "o_totalprice")


@query("page", """SELECT event_id, value FROM events ORDER BY value DESC, event_id ASC LIMIT 500 OFFSET 500""")
def q_page(spark, d):
    e = R.table(spark, d, "events")
    return page(e, [F.col("value").desc(), F.col("event_id").asc()], limit=500, offset=500).select(
        "event_id", "value")


# --------------------------------------------------------------- upsert, documents

_UPSERT_SQL = """WITH src AS (
  SELECT p_partkey, p_name, p_retailprice + 1.0 AS p_retailprice FROM part WHERE p_size <= 25
  UNION ALL SELECT p_partkey + 10000000, 'new ' || p_name, p_retailprice FROM part WHERE p_size = 50
  UNION ALL SELECT NULL, p_name, p_retailprice FROM part WHERE p_size = 49
  UNION ALL SELECT p_partkey, p_name, p_retailprice + 2.0 FROM part WHERE p_size = 48
  UNION ALL SELECT p_partkey, p_name, p_retailprice + 3.0 FROM part WHERE p_size = 48),
ok AS (SELECT * FROM src WHERE p_partkey IN (
         SELECT p_partkey FROM src WHERE p_partkey IS NOT NULL GROUP BY p_partkey HAVING count(*) = 1)),
merged AS (SELECT p_partkey, p_name, p_retailprice FROM part
           WHERE p_partkey NOT IN (SELECT p_partkey FROM ok)
           UNION ALL SELECT * FROM ok)"""


def upsert_source(spark, d):
    """Target and source of the upserts: new prices, new items, NULL and repeated keys."""
    p = R.table(spark, d, "part")
    target = p.select("p_partkey", "p_name", "p_retailprice")
    src = (p.filter("p_size <= 25").select("p_partkey", "p_name", (F.col("p_retailprice") + 1.0).alias("p_retailprice"))
           .unionByName(p.filter("p_size = 50").select((F.col("p_partkey") + 10_000_000).alias("p_partkey"),
                                                        F.concat(F.lit("new "), "p_name").alias("p_name"),
                                                        "p_retailprice"))
           .unionByName(p.filter("p_size = 49").select(F.lit(None).cast("long").alias("p_partkey"), "p_name",
                                                        "p_retailprice"))
           .unionByName(p.filter("p_size = 48").select("p_partkey", "p_name",
                                                        (F.col("p_retailprice") + 2.0).alias("p_retailprice")))
           .unionByName(p.filter("p_size = 48").select("p_partkey", "p_name",
                                                        (F.col("p_retailprice") + 3.0).alias("p_retailprice"))))
    return target, src


def _upserted(spark, d):
    return upsert(*upsert_source(spark, d), ["p_partkey"])


@query("upsert_items", _UPSERT_SQL + "\nSELECT p_partkey, p_name, round(p_retailprice, 6) AS p_retailprice FROM merged")
def q_upsert_items(spark, d):
    return _upserted(spark, d).select("p_partkey", "p_name", r6("p_retailprice").alias("p_retailprice"))


@query("documents", _UPSERT_SQL + """
SELECT p_partkey::VARCHAR AS doc_id,
       to_json({'p_partkey': p_partkey, 'p_name': p_name, 'p_retailprice': p_retailprice})::VARCHAR AS body
FROM merged""")
def q_documents(spark, d):
    return to_documents(_upserted(spark, d), "p_partkey")


# --------------------------------------------------------------- frontier

def _edges(spark, d, distinct=True):
    li = R.table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    o = R.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    bought = li.join(o, li["l_orderkey"] == o["o_orderkey"]).select("o_custkey", "l_partkey")
    # made distinct as numbers and one way: the two ways have no edge in common
    e = (bought.distinct() if distinct else bought).select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("src"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"))
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def _seeds(spark, d):
    o = R.table(spark, d, "orders")
    return o.agg(F.concat(F.lit("c"), F.min("o_custkey").cast("string")).alias("node"))


def _bfs_sql(steps: int, batch: int) -> str:
    parts = ["""e AS (SELECT DISTINCT 'c' || o.o_custkey AS src, 'p' || l.l_partkey AS dst
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
             "edges AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e)",
             "s0 AS (SELECT 'c' || min(o_custkey) AS node, 'queued' AS status FROM orders)"]
    for i in range(1, steps + 1):
        p = f"s{i - 1}"
        parts += [
            f"""b{i} AS (SELECT node FROM {p} WHERE status = 'queued'
      AND node NOT IN (SELECT node FROM {p} WHERE status = 'processed') ORDER BY node LIMIT {batch})""",
            f"""d{i} AS (SELECT DISTINCT dst AS node FROM edges WHERE src IN (SELECT node FROM b{i})
      EXCEPT SELECT node FROM {p})""",
            f"p{i} AS (SELECT node FROM {p} WHERE status = 'processed' UNION SELECT node FROM b{i})",
            f"""q{i} AS ((SELECT node FROM {p} WHERE status = 'queued' UNION SELECT node FROM d{i})
      EXCEPT SELECT node FROM p{i})""",
            f"""s{i} AS (SELECT node, 'processed' AS status FROM p{i}
      UNION ALL SELECT node, 'queued' AS status FROM q{i})"""]
    return "WITH " + ",\n".join(parts) + f"\nSELECT node, status FROM s{steps}"


@query("frontier_step", _bfs_sql(1, 50))
def q_frontier_step(spark, d):
    # one step makes what it finds distinct itself
    return fr.frontier_step(_edges(spark, d, distinct=False), fr.seed_state(_seeds(spark, d)), batch=50)


@query("bfs", """WITH RECURSIVE e AS (SELECT DISTINCT 'c' || o.o_custkey AS src, 'p' || l.l_partkey AS dst
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
edges AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
reach AS (SELECT 'c' || min(o_custkey) AS node FROM orders UNION SELECT dst FROM edges JOIN reach ON src = node)
SELECT node, 'processed' AS status FROM reach""")
def q_bfs(spark, d):
    """G4 to the end: edges written once, steps until the queue is empty."""
    return fr.bfs(materialize(_edges(spark, d), "edges"), _seeds(spark, d))


# --------------------------------------------------------------- streaming loads

_EVENT_COLS = ["event_id", "user_id", "event_type", "value"]


@query("stream_append", """SELECT event_id, user_id, event_type, value FROM events
WHERE user_id IS NOT NULL AND value > 0""")
def q_stream_append(spark, d):
    """O3/K3 on the events file: drained twice on one checkpoint (the second
    run finds no new file and appends nothing), then read back."""
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    schema = R.table(spark, d, "events").schema

    def valid(s):
        return s.filter(F.col("user_id").isNotNull() & (F.col("value") > 0)).select(*_EVENT_COLS)

    for _ in range(2):
        load_batches(spark, d, out, ck, schema, fmt="parquet", transform=valid, path_glob="events.parquet")
    return spark.read.parquet(out)


@query("load_batches", "SELECT event_id, user_id, event_type, value FROM events")
def q_load_batches(spark, d):
    """The events staged as 8 files, loaded 2 files per micro-batch."""
    staged = scratch_path(spark, "staged-events")
    R.table(spark, d, "events").select(*_EVENT_COLS).repartition(8, "event_id").write.parquet(staged)
    out, ck = scratch_path(spark, "batches-out"), scratch_path(spark, "batches-ckpt")
    schema = spark.read.parquet(staged).schema
    load_batches(spark, staged, out, ck, schema, fmt="parquet", files_per_batch=2, path_glob="*.parquet")
    return spark.read.parquet(out)


# --------------------------------------------------------------- reports

@query("report_cohort_sizes", "WITH " + S.lift_sql(R.MIN_USERS, R.MIN_SHARE) + """
SELECT cohort_id, cohort_name, count(*) AS n_users FROM lab GROUP BY cohort_id, cohort_name""")
def q_report_cohort_sizes(spark, d):
    return rep.report_cohort_sizes(_labelled(spark, d, _inter(spark, d)), "cohort_id")


@query("report_top_items", "WITH " + S.reco_sql(R.MIN_USERS, R.MIN_SHARE, R.MIN_SCORE, R.MAX_SHARE,
                                               R.PER_COHORT, R.PER_USER) + """,
cnt AS (SELECT cohort_id, item_id, count(*) AS n_users, max(item_name) AS item_name FROM ranked
        GROUP BY cohort_id, item_id)
SELECT cohort_id, item_id, n_users, item_name, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY cohort_id ORDER BY n_users DESC, item_id ASC) AS rank FROM cnt)
WHERE rank <= 5""")
def q_report_top_items(spark, d):
    return rep.report_top_items(_recommend(spark, d), "cohort_id", "item_id", 5)


@query("report_neighbour_overlap", S.similarity_sql(None, R.NEIGHBOURS, "all", f"""SELECT p.p_partkey AS item_id,
  1::BIGINT AS n_editorial, count(r.id) AS n_computed,
  (CASE WHEN count(r.id) FILTER (WHERE r.nbr_name = p.p_name) > 0 THEN 1 ELSE 0 END)::BIGINT AS n_shared
FROM part p LEFT JOIN (SELECT * FROM ranked WHERE rank <= {R.NEIGHBOURS}) r ON r.id = p.p_partkey
GROUP BY p.p_partkey"""))
def q_report_neighbour_overlap(spark, d):
    items = R.items(spark, d).withColumn("similar_game_names", F.array("item_name"))
    cat = sim.compute_similar_games(items, "item_id", "item_name", ["genre_names", "theme_names", "tag_names"],
                                    k=R.NEIGHBOURS)
    out = rep.report_neighbour_overlap(cat, "item_id")
    return out.select("item_id", *[F.col(c).cast("long").alias(c) for c in ("n_editorial", "n_computed",
                                                                               "n_shared")])


# --------------------------------------------------------------- learned cohorts (rows-only)

def _kmeans(spark, d, k=8):
    """Interactions, user tags (both written once), assignments and predictions."""
    inter = _inter(spark, d)
    counts = materialize(_user_tags(spark, d, inter), "user-tags")
    arrays = feat.user_tag_arrays(counts, inter, "user_id")
    return inter, counts, *feat.assign_cohorts(arrays, "user_id", k=k, seed=42, min_df=R.MIN_DF)


@query("cohorts_kmeans")
def q_cohorts_kmeans(spark, d):
    return _kmeans(spark, d)[2]


@query("cohort_quality")
def q_cohort_quality(spark, d):
    pred = _kmeans(spark, d)[3]
    return spark.createDataFrame([(feat.cohort_quality(pred),)], "silhouette double")


@query("learned_cohort_profile")
def q_learned_cohort_profile(spark, d):
    """O8 on K-Means cohorts (K = 8 bounds the broadcast of the size table)."""
    _, counts, assign, _ = _kmeans(spark, d)
    return coh.cohort_profile(counts, assign, "user_id", "cohort_id", n_cohorts=8,
                              min_users=R.MIN_USERS, min_share=R.MIN_SHARE)


@query("learned_recommend")
def q_learned_recommend(spark, d):
    """O9 on K-Means cohorts: the reference's own flow end to end."""
    inter, counts, assign, _ = _kmeans(spark, d)
    labelled = materialize(coh.cohort_profile(counts, assign, "user_id", "cohort_id", n_cohorts=8,
                                              min_users=R.MIN_USERS, min_share=R.MIN_SHARE), "labelled")
    ranked = rec.recommend(inter, labelled, None, "user_id", "item_id", "item_name", cohort="cohort_id",
                           min_score=R.MIN_SCORE, max_share=R.MAX_SHARE, n_cohorts=8)
    return rec.pack_recommendations(ranked, "user_id", "item_id", "cohort_id").select(
        "user_id", "cohort_id", "cohort_name", F.array_join("recommended_games", "|").alias("recommended_games"),
        F.size("recommended_ids").alias("n_recommended"))


# --------------------------------------------------------------- more inventory rows

@query("distinct_items", f"""WITH {S.PR}
SELECT count(DISTINCT item_id) AS n_items FROM pr WHERE playtime_forever > 0""")
def q_distinct_items(spark, d):
    """Distinct items with interactions."""
    return R.positive_rows(spark, d).select("item_id").distinct().agg(F.count(F.lit(1)).alias("n_items"))


@query("recent_page", """SELECT event_id, user_id, value FROM events
WHERE ts > TIMESTAMP '2024-01-04 00:00:00' AND value > 10
ORDER BY ts DESC, event_id DESC LIMIT 500""")
def q_recent_page(spark, d):
    """L2: newest page of a delta (changed since a date, capped)."""
    e = changed_since(R.table(spark, d, "events"), "ts", "2024-01-05", days=1, min_col="value", min_value=10)
    return page(e, [F.col("ts").desc(), F.col("event_id").desc()], limit=500).select("event_id", "user_id", "value")


@query("consolidate_libraries", f"""WITH {S.PR},
n AS (SELECT user_id FROM pr GROUP BY user_id HAVING count(*) >= 1)
SELECT pr.user_id::VARCHAR AS steam_id, pr.item_id AS appid, pr.playtime_forever::BIGINT AS playtime_forever
FROM pr JOIN n USING (user_id)""")
def q_consolidate_libraries(spark, d):
    """O3 end to end: per-user library JSON (written by Spark from the
    tables) drained by the file stream with the
    library size filter, then read back and exploded."""
    from playlens.operators.engagement import explode_libraries, library_envelope
    from playlens.streaming.loads import consolidate_libraries

    rows = R.purchase_rows(spark, d).join(R.items(spark, d).select("item_id", "item_name"), "item_id").select(
        F.col("user_id").cast("string").alias("steam_id"), F.col("item_id").alias("appid"),
        F.col("item_name").alias("name"), F.col("playtime_forever").cast("long").alias("playtime_forever"),
        F.col("playtime_2weeks").cast("long").alias("playtime_2weeks"))
    env = library_envelope(rows, "steam_id", ["appid", "name", "playtime_forever", "playtime_2weeks"], "appid",
                           captured_at=F.lit("2024-01-01T00:00:00"))
    raw = scratch_path(spark, "raw-libraries")
    env.select("steam_id", F.col("captured_at").alias("scraped_at"), "games").write.json(raw)
    out, ck = scratch_path(spark, "libraries"), scratch_path(spark, "libraries-ckpt")
    consolidate_libraries(spark, raw, out, ck)
    libs = spark.read.parquet(out)
    return explode_libraries(libs, fields={"appid": "appid", "playtime_forever": "playtime_forever"})


@query("catalogue_pages", """SELECT p_partkey, p_retailprice,
       ((row_number() OVER (ORDER BY p_retailprice DESC, p_partkey ASC) - 1) // 40 + 1)::INTEGER AS page
FROM part""")
def q_catalogue_pages(spark, d):
    """L3: the whole catalogue by price, 40 per page."""
    from playlens.operators.resolve import pages

    p = R.table(spark, d, "part").select("p_partkey", "p_retailprice")
    return pages(p, [F.col("p_retailprice").desc(), F.col("p_partkey").asc()], page_size=40)
