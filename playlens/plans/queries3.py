"""Registered queries, part 3: raw files with bad records, loads, sinks and keyed
tables, served documents, counted writes, chunked and bounded libraries,
enrichment over shared ids, filters that bite, cursors, checked cohorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from playlens.functions.nested import arr_or_empty
from playlens.functions.scalar import slug
from playlens.operators import cohorts as coh
from playlens.operators import engagement as eng
from playlens.operators import features as feat
from playlens.operators import recommend as rec
from playlens.operators.reports import preview
from playlens.operators.resolve import keyset_page
from playlens.operators.upsert import merge_rows
from playlens.plans import roles as R
from playlens.plans import sql as S
from playlens.plans.queries import _inter, _user_tags, query, r6
from playlens.plans.queries2 import _UPSERT_SQL, upsert_source
from playlens.session import materialize, scratch_path
from playlens.sources import keyed, sinks
from playlens.sources.readers import daily_path, judged_records, read_gold, read_loads, read_raw_json_checked
from playlens.streaming.loads import consolidate_libraries, run_counted

# --------------------------------------------------------------- raw files

#: Records of one raw file, about.
PER_FILE = 100


def _raw_files(spark, rows, group, load, broken):
    """Writes each load and group as a JSON array file below ``load=<load>``;
    ``broken`` groups lose their last character."""
    root = scratch_path(spark, "raw-json")
    files = rows.groupBy(load.alias("load"), group.alias("g")).agg(F.sort_array(F.collect_list("record")).alias("r"))
    text = F.concat(F.lit("[\n"), F.array_join("r", ",\n"), F.lit("\n]"))
    cut = F.substring(text, F.lit(1), F.length(text) - 1)
    (files.select("load", F.when(broken, cut).otherwise(text).alias("value"))
     .write.partitionBy("load").option("maxRecordsPerFile", 1).text(root))
    return root


def _part_files(spark, d):
    p = R.table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    record = F.when(F.col("p_size") == 50, F.to_json(F.struct(F.col("p_name").alias("name")))).when(
        F.col("p_size") == 49, F.to_json(F.struct(F.concat(F.lit("no"), "p_partkey").alias("id"), F.col("p_name").alias("name")))
    ).otherwise(F.to_json(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))))
    group = F.floor(F.col("p_partkey") / PER_FILE)
    return _raw_files(spark, p.withColumn("record", record), group, F.lit("bulk"), F.col("g") % 7 == 3)


_PART_FILES_SQL = f"""WITH f AS (SELECT p_partkey, p_name, p_size, p_partkey // {PER_FILE} AS g FROM part),
whole AS (SELECT * FROM f WHERE g % 7 <> 3)"""


@query("raw_json_glob", _PART_FILES_SQL + """
SELECT p_partkey AS id, p_name AS name FROM whole WHERE p_size NOT IN (49, 50)""")
def q_raw_json_glob(spark, d):
    """Array files by glob, the good records of the files that are whole."""
    root = _part_files(spark, d)
    return read_raw_json_checked(spark, f"{root}/load=*/*", "id BIGINT, name STRING")[0]


@query("raw_json_rejects", _PART_FILES_SQL + """
SELECT 'broken' AS reason, (SELECT count(DISTINCT g) FROM f WHERE g % 7 = 3)
       + (SELECT count(*) FROM whole WHERE p_size = 49) AS n_records
UNION ALL SELECT 'no_key', count(*) FROM whole WHERE p_size = 50
UNION ALL SELECT 'good', count(*) FROM whole WHERE p_size NOT IN (49, 50)""")
def q_raw_json_rejects(spark, d):
    """Every record of the same files by what became of it."""
    judged = judged_records(spark, f"{_part_files(spark, d)}/load=*/*", "id BIGINT, name STRING")
    return judged.groupBy(F.coalesce("reason", F.lit("good")).alias("reason")).agg(F.count(F.lit(1)).alias("n_records"))


@query("raw_json_daily", """SELECT o_orderkey AS id, o_totalprice AS price FROM orders
WHERE strftime(o_orderdate, '%Y%m') = '199603'""")
def q_raw_json_daily(spark, d):
    """The files of one load date alone."""
    o = R.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    rows = o.withColumn("record", F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))))
    # a month has about one order in 80
    root = _raw_files(spark, rows, F.floor(F.col("o_orderkey") / (80 * PER_FILE)), F.date_format("o_orderdate", "yyyyMM"), F.lit(False))
    return read_raw_json_checked(spark, daily_path(root + "/load={date}/*", "199603"), "id BIGINT, price DOUBLE")[0]


# --------------------------------------------------------------- loads and sinks

_LOADS_SQL = """WITH loads AS (
  SELECT p_partkey, p_name, '' AS p_brand, 'initial' AS dt FROM part WHERE p_size <= 20
  UNION ALL SELECT p_partkey, upper(p_name), p_brand, '20240101' FROM part WHERE p_size BETWEEN 15 AND 30
  UNION ALL SELECT p_partkey, '', p_brand, '20240102' FROM part WHERE p_size > 30)"""


def _silver(spark, d):
    """Three loads whose columns differ; the first daily one is written twice (K1)."""
    p, root = R.table(spark, d, "part"), scratch_path(spark, "silver")
    first = p.where("p_size <= 20").select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name")
    sinks.write_partition(first, root, "initial")
    again = p.where("p_size BETWEEN 15 AND 30").select("p_partkey", "p_name", "p_brand", "p_size")
    sinks.write_partition(again.limit(7), root, "20240101")
    sinks.write_partition(again.withColumn("p_name", F.upper("p_name")), root, "20240101")
    sinks.write_loads(p.where("p_size > 30").select("p_partkey", "p_brand", F.lit("20240102").alias("dt")), root)
    return root


@query("silver_loads", _LOADS_SQL + "\nSELECT * FROM loads")
def q_silver_loads(spark, d):
    """Loads that lack columns or have others, as one frame of fixed types."""
    return read_loads(spark, _silver(spark, d), "p_partkey BIGINT, p_name STRING, p_brand STRING", {"p_name": "", "p_brand": ""})


@query("silver_one_load", _LOADS_SQL + "\nSELECT p_partkey, p_brand FROM loads WHERE dt = '20240102'")
def q_silver_one_load(spark, d):
    """One ``dt`` asked for, its folder alone is scanned."""
    return read_loads(spark, _silver(spark, d), "p_partkey BIGINT, p_brand STRING", loads=["20240102"]).drop("dt")


@query("silver_merged", """SELECT p_partkey, nullif(p_name, '') AS p_name, nullif(p_brand, '') AS p_brand, dt,
       p_size FROM (""" + _LOADS_SQL + """
SELECT l.*, CASE WHEN dt = '20240101' THEN p.p_size END AS p_size FROM loads l JOIN part p USING (p_partkey)) x""")
def q_silver_merged(spark, d):
    """The schema inferred by merging those of the loads."""
    return read_loads(spark, _silver(spark, d)).select("p_partkey", "p_name", "p_brand", "dt", "p_size")


@query("gold_overwrite", "SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey")
def q_gold_overwrite(spark, d):
    """A derived table replaced as a whole and read back."""
    path = scratch_path(spark, "gold")
    counts = R.table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    sinks.write_gold(counts.where("n_orders > 3"), path)
    sinks.write_gold(counts, path)
    return read_gold(spark, path)


@query("sized_files", "SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders, true AS even FROM lineitem")
def q_sized_files(spark, d):
    """K2: files by size; no file has over twice the rows of the average one (and a thousand)."""
    path = scratch_path(spark, "sized")
    with sinks.file_bytes(spark, 1 << 20):
        sinks.write_gold(R.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"), path)
    back = read_gold(spark, path)
    files = back.groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("l_orderkey").alias("n_orders")).withColumn(
        "even", files.agg(F.max("n") <= 2 * F.avg("n") + 1000).scalar())


# --------------------------------------------------------------- keyed tables and documents

def _keyed_table(spark, d):
    """K5, K6: ``part`` as a keyed table with one upsert; path and refused keys."""
    path = scratch_path(spark, "keyed")
    target, source = upsert_source(spark, d)
    keyed.init_keyed(target, path, ["p_partkey"])
    return path, keyed.upsert_keyed(source, path, ["p_partkey"])


@query("keyed_upsert", _UPSERT_SQL + "\nSELECT p_partkey, p_name, round(p_retailprice, 6) AS p_retailprice FROM merged")
def q_keyed_upsert(spark, d):
    """The table after the upsert, as it stands."""
    path, _ = _keyed_table(spark, d)
    return keyed.read_keyed(spark, path).select("p_partkey", "p_name", r6("p_retailprice").alias("p_retailprice"))


@query("keyed_refused", _UPSERT_SQL + """
SELECT p_partkey, CASE WHEN p_partkey IS NULL THEN 'null_key' ELSE 'duplicate_key' END AS status, count(*) AS n_source
FROM src GROUP BY p_partkey HAVING p_partkey IS NULL OR count(*) > 1""")
def q_keyed_refused(spark, d):
    """K6: the source keys that the upsert refused, and how many rows each has."""
    return _keyed_table(spark, d)[1]


@query("upsert_status", _UPSERT_SQL + """,
n AS (SELECT p_partkey, count(*) AS n FROM src GROUP BY p_partkey),
s AS (SELECT CASE WHEN n.n IS NULL THEN 'kept' WHEN n.p_partkey IS NULL THEN 'null_key' WHEN n.n > 1 THEN 'duplicate_key'
             WHEN p.p_partkey IS NULL THEN 'inserted' ELSE 'updated' END AS status
      FROM part p FULL JOIN n ON p.p_partkey = n.p_partkey)
SELECT status, count(*) AS n_keys FROM s GROUP BY status""")
def q_upsert_status(spark, d):
    """K6: what the merge does to each key."""
    merged = merge_rows(*upsert_source(spark, d), ["p_partkey"])
    return merged.groupBy("status").agg(F.count(F.lit(1)).alias("n_keys"))


def _doc_loads(spark, d):
    p = R.table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    return p.where("p_size <= 30"), p.where("p_size > 20").withColumn("p_name", F.upper("p_name"))


_DOC = "p_partkey::VARCHAR AS doc_id, to_json({'p_partkey': p_partkey, 'p_name': n, 'p_size': p_size})::VARCHAR AS body"


@query("serve_upsert", f"""SELECT {_DOC}
FROM (SELECT p_partkey, p_size, CASE WHEN p_size > 20 THEN upper(p_name) ELSE p_name END AS n FROM part) x""")
def q_serve_upsert(spark, d):
    """Documents of two loads; those that the second lacks stay."""
    path = scratch_path(spark, "served")
    for load in _doc_loads(spark, d):
        keyed.serve_upsert(load, "p_partkey", path)
    return keyed.read_keyed(spark, path)


@query("serve_replace", f"SELECT {_DOC} FROM (SELECT p_partkey, p_size, upper(p_name) AS n FROM part WHERE p_size > 20) x")
def q_serve_replace(spark, d):
    """The second load's documents alone."""
    path = scratch_path(spark, "replaced")
    for load in _doc_loads(spark, d):
        keyed.serve_replace(load, "p_partkey", path)
    return read_gold(spark, path)


# --------------------------------------------------------------- counted writes

@query("counted_write", """SELECT count(*) FILTER (value > 10) AS written, count(*) AS n_read,
       count(*) FILTER (value IS NULL OR value <= 10) AS n_rejected FROM events""")
def q_counted_write(spark, d):
    """Rows read and rejected, counted by the write itself."""
    path, ok = scratch_path(spark, "counted"), F.col("value") > 10
    seen = sinks.write_counted(R.table(spark, d, "events"), lambda df: df.write.parquet(path), keep=ok, counts={
        "n_read": F.count(F.lit(1)), "n_rejected": sinks.counted_if(~F.coalesce(ok, F.lit(False)))})
    return read_gold(spark, path).agg(F.count(F.lit(1)).alias("written")).select(
        "written", *[F.lit(seen[c]).cast("long").alias(c) for c in ("n_read", "n_rejected")])


@query("counted_stream", """SELECT count(*) FILTER (value > 10) AS written, count(*) AS n_read,
       count(*) FILTER (value IS NULL OR value <= 10) AS n_rejected, true AS in_batches FROM events""")
def q_counted_stream(spark, d):
    """The same by a stream, one staged file per micro-batch."""
    staged, ok = scratch_path(spark, "staged"), F.col("value") > 10
    R.table(spark, d, "events").select("event_id", "value").repartition(6, "event_id").write.parquet(staged)
    sdf = (spark.readStream.schema(spark.read.parquet(staged).schema).option("maxFilesPerTrigger", 1)
           .option("pathGlobFilter", "*.parquet").parquet(staged))
    path = scratch_path(spark, "counted-stream")
    seen = run_counted(sdf, path, scratch_path(spark, "counted-ck"), keep=ok, counts={
        "n_read": F.count(F.lit(1)), "n_rejected": F.count_if(~F.coalesce(ok, F.lit(False)))})
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("written")).select(
        "written", *[F.lit(seen[c]).cast("long").alias(c) for c in ("n_read", "n_rejected")],
        F.lit(seen["batches"] > 1).alias("in_batches"))


@query("preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def q_preview(spark, d):
    """The five dearest orders."""
    return preview(R.table(spark, d, "orders"), [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]).select(
        "o_orderkey", "o_totalprice")


# --------------------------------------------------------------- libraries

def _library_rows(spark, d):
    return R.purchase_rows(spark, d).select(
        F.col("user_id").cast("string").alias("steam_id"), F.col("item_id").alias("appid"),
        F.col("playtime_forever").cast("long").alias("playtime_forever"))


@query("library_chunks", f"""WITH {S.PR},
n AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY item_id) - 1 AS i FROM pr)
SELECT user_id, i // 16 AS chunk, min(i) AS first, count(*)::INTEGER AS n_games,
       string_agg(item_id::VARCHAR, ',' ORDER BY i) AS items FROM n GROUP BY user_id, i // 16""")
def q_library_chunks(spark, d):
    """Libraries of any size in lists of at most 16."""
    chunks = eng.library_chunks(R.purchase_rows(spark, d), "user_id", ["item_id"], ["item_id"], size=16)
    return chunks.select("user_id", "chunk", "first", "n_games", F.array_join(
        F.transform("games", lambda g: g["item_id"].cast("string")), ",").alias("items"))


@query("library_bounded", f"""WITH {S.PR},
n AS (SELECT user_id FROM pr GROUP BY user_id HAVING count(*) BETWEEN 35 AND 45)
SELECT user_id, item_id, playtime_forever FROM pr JOIN n USING (user_id)""")
def q_library_bounded(spark, d):
    """libraries of 35 to 45 items; all others are left out."""
    return eng.capped_library_rows(R.purchase_rows(spark, d), "user_id", max_items=45, min_items=35).select(
        "user_id", "item_id", "playtime_forever")


@query("consolidate_bounded", f"""WITH {S.PR},
n AS (SELECT user_id, item_id, playtime_forever, row_number() OVER (PARTITION BY user_id ORDER BY item_id) - 1 AS i FROM pr),
c AS (SELECT *, count(*) OVER (PARTITION BY user_id, i // 16) AS in_chunk, count(*) OVER (PARTITION BY user_id) AS size FROM n)
SELECT user_id::VARCHAR AS steam_id, item_id AS appid, playtime_forever::BIGINT AS playtime_forever
FROM c WHERE size <= 40 AND in_chunk <= 12""")
def q_consolidate_bounded(spark, d):
    """O3: chunked library files drained by the stream; F2 on the records (at most 12
    elements) and on whole libraries (at most 40) by their counts."""
    chunks = eng.library_chunks(_library_rows(spark, d), "steam_id", ["appid", "playtime_forever"], ["appid"],
                                size=16, max_items=40)
    raw = scratch_path(spark, "raw-chunks")
    chunks.select("steam_id", F.lit("2024-01-01T00:00:00").alias("scraped_at"), "games").write.json(raw)
    out = scratch_path(spark, "chunk-libraries")
    consolidate_libraries(spark, raw, out, scratch_path(spark, "chunk-ck"), max_items=12)
    return eng.explode_libraries(spark.read.parquet(out), fields={"appid": "appid", "playtime_forever": "playtime_forever"})


@query("enrich_shared_ids", """WITH cat AS (SELECT p_partkey % 500 AS app_id, p_partkey, p_brand || ' ' || p_type AS tag FROM part),
u AS (SELECT app_id, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags FROM cat GROUP BY app_id)
SELECT l_orderkey, l_linenumber, l_partkey % 500 AS app_id, tags FROM lineitem LEFT JOIN u ON u.app_id = l_partkey % 500""")
def q_enrich_shared_ids(spark, d):
    """Several catalogue rows an app id; a row gets the tags of all, once."""
    li = R.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 500).alias("app_id"))
    items = R.items(spark, d).withColumn("app_id", F.col("item_id") % 500)
    out = eng.enrich(li, items, "app_id", ["profile_tags"], order_by=[F.col("item_id")], union=["profile_tags"])
    return out.select("l_orderkey", "l_linenumber", "app_id", F.array_join("profile_tags", "|").alias("tags"))


# --------------------------------------------------------------- filters that bite

@query("positive_discounts", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount > 0")
def q_positive_discounts(spark, d):
    """lines without a discount go."""
    return eng.positive(R.table(spark, d, "lineitem"), "l_discount").select("l_orderkey", "l_linenumber", "l_discount")


@query("empty_arrays", """SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 0 ELSE len(string_split(p_name, ' ')) END::INTEGER AS n_words
FROM part""")
def q_empty_arrays(spark, d):
    """A fifth of the arrays is NULL and becomes empty."""
    words = F.when(F.col("p_size") % 5 != 0, F.split("p_name", " "))
    return R.table(spark, d, "part").select("p_partkey", F.size(arr_or_empty(words)).alias("n_words"))


#: What customers of a nation like: two words pass, two are stop words, two have a stop pattern.
LIKES = ["Puzzle", "Racing", "Open World", "Board Games", "Chess", "Remote Play"]
_LIKES_SQL = "CASE c_nationkey % 6 " + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(LIKES)) + " END"


@query("cohort_names_filtered", f"""WITH coh AS (SELECT c_custkey AS user_id,
    CASE WHEN c_custkey % 50 = 0 THEN 'D' ELSE chr((65 + c_nationkey % 3)::INTEGER) END AS cohort_id FROM customer),
ut AS (SELECT user_id, {S.slug_sql('tag')} AS tag FROM (
         SELECT c_custkey AS user_id, {_LIKES_SQL} AS tag FROM customer WHERE c_custkey % 50 <> 0
         UNION ALL SELECT c_custkey, 'Rare Gem' FROM customer WHERE c_custkey % 50 = 0) x)"""
       + S.lift_sql(100, 0.15)[len(S.COHORTS):] + "\nSELECT user_id, cohort_id, cohort_name FROM lab")
def q_cohort_names_filtered(spark, d):
    """Stop tags, the stop pattern, the least number of users and the
    default label each decide a cohort's name."""
    c = R.table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    few = F.col("user_id") % 50 == 0
    like = F.element_at(F.array(*[F.lit(w) for w in LIKES]), (F.col("c_nationkey") % 6 + 1).cast("int"))
    tags = c.select("user_id", slug(F.when(few, "Rare Gem").otherwise(like)).alias("tag"))
    cohorts = c.select("user_id", F.when(few, "D").otherwise(
        F.char((F.col("c_nationkey") % 3 + 65).cast("int"))).alias("cohort_id"))
    return coh.cohort_profile(tags, cohorts, "user_id", "cohort_id", n_cohorts=4, min_users=100, min_share=0.15).select(
        "user_id", "cohort_id", "cohort_name")


# --------------------------------------------------------------- cursors

@query("keyset_page", """SELECT event_id, value FROM events ORDER BY value DESC, event_id ASC LIMIT 400 OFFSET 800""")
def q_keyset_page(spark, d):
    """L1: the third page, reached by cursors."""
    e, cursor = R.table(spark, d, "events").select("event_id", "value"), None
    for _ in range(3):
        rows, cursor = keyset_page(e, [("value", True), ("event_id", False)], 400, cursor)
    return rows


@query("keyset_recent", """SELECT event_id, user_id, value FROM events WHERE ts > TIMESTAMP '2024-01-04 00:00:00'
ORDER BY ts DESC, event_id DESC LIMIT 300 OFFSET 300""")
def q_keyset_recent(spark, d):
    """L2: the second page of a delta, newest first."""
    from playlens.operators.resolve import changed_since

    e, cursor = changed_since(R.table(spark, d, "events"), "ts", "2024-01-05", days=1), None
    for _ in range(2):
        rows, cursor = keyset_page(e, [("ts", True), ("event_id", True)], 300, cursor)
    return rows.select("event_id", "user_id", "value")


# --------------------------------------------------------------- learned cohorts, checked

def _learned(spark, d, k=8):
    """Assignments of seeded K-Means, written once, with the TF-IDF rows they come from."""
    inter = _inter(spark, d)
    counts = materialize(_user_tags(spark, d, inter), "user-tags")
    arrays = feat.user_tag_arrays(counts, inter, "user_id")
    assign, _, centres = feat.learn_cohorts(arrays, "user_id", k=k, seed=42, min_df=R.MIN_DF)
    weights = materialize(feat.tfidf(counts, inter, "user_id", min_df=R.MIN_DF).select("user_id", "tag", "weight"), "tfidf")
    return inter, counts, materialize(assign, "cohorts"), weights, centres


@query("cohorts_checked", f"""WITH {S.PR}
SELECT count(DISTINCT user_id) AS n_users, true AS one_cohort_each, true AS no_cohort_empty, 0::BIGINT AS n_nearer_elsewhere,
       true AS silhouette_agrees
FROM pr WHERE playtime_forever > 0""")
def q_cohorts_checked(spark, d):
    """Every user has one of 8 cohorts and no centre of another one is
    nearer; the closed-form silhouette equals the library's."""
    inter, counts, assign, weights, centres = _learned(spark, d)
    own = feat.cohort_silhouette(weights, assign, "user_id")
    arrays = feat.user_tag_arrays(counts, inter, "user_id")
    _, features = feat.tfidf_features(arrays, min_df=R.MIN_DF)
    library = feat.cohort_quality(features.join(assign, "user_id"))
    return assign.agg(F.count_distinct("user_id").alias("n_users"),
                      (F.count(F.lit(1)) == F.count_distinct("user_id")).alias("one_cohort_each"),
                      (F.count_distinct("cohort_id") == 8).alias("no_cohort_empty")).select(
        "*", feat.nearer_elsewhere(weights, assign, centres, "user_id").agg(F.count(F.lit(1))).scalar().alias("n_nearer_elsewhere"),
        (F.abs(own.agg(F.avg("silhouette")).scalar() - F.lit(library)) < 1e-6).alias("silhouette_agrees"))


@query("learned_checked", f"""WITH {S.PR},
users AS (SELECT DISTINCT user_id FROM pr WHERE playtime_forever > 0)
SELECT count(*) AS n_users, 0::BIGINT AS n_owned, 0::BIGINT AS n_wrong_rank, 0::BIGINT AS n_other_cohort FROM users""")
def q_learned_checked(spark, d):
    """O8, O9 on learned cohorts: all users are labelled; nothing owned is recommended, ranks
    run from 1 without gaps to at most 10, and an item comes from the user's own cohort."""
    inter, counts, assign, _, _ = _learned(spark, d)
    labelled = materialize(coh.cohort_profile(counts.select("user_id", "tag"), assign, "user_id", "cohort_id", n_cohorts=8,
                                              min_users=R.MIN_USERS, min_share=R.MIN_SHARE), "labelled")
    ranked = materialize(rec.recommend(inter, labelled, None, "user_id", "item_id", "item_name", cohort="cohort_id",
                                       min_score=R.MIN_SCORE, max_share=R.MAX_SHARE, n_cohorts=8), "ranked")
    owned = ranked.join(inter.select("user_id", "item_id"), ["user_id", "item_id"], "left_semi")
    per = ranked.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("reco_rank").alias("top"),
                                        F.count_distinct("reco_rank").alias("d"))
    wrong = per.where((F.col("n") != F.col("top")) | (F.col("n") != F.col("d")) | (F.col("n") > 10))
    other = ranked.join(assign.withColumnRenamed("cohort_id", "own"), "user_id").where(F.col("own") != F.col("cohort_id"))
    count = F.count(F.lit(1))
    return labelled.agg(F.count_distinct("user_id").alias("n_users")).select(
        "n_users", owned.agg(count).scalar().alias("n_owned"), wrong.agg(count).scalar().alias("n_wrong_rank"),
        other.agg(count).scalar().alias("n_other_cohort"))
