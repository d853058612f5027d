"""Shared pieces of the DuckDB oracle SQL (independent formulations of the
same roles as ``roles.py``: plain joins, GROUP BY and window functions)."""

PR = """pr AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
         sum(l.l_quantity) AS playtime_forever,
         sum(CASE WHEN l.l_linestatus = 'O' THEN l.l_quantity END) AS playtime_2weeks
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, l.l_partkey)"""

INTER = PR + """,
act AS (SELECT * FROM pr WHERE playtime_forever > 0),
inter AS (
  SELECT a.user_id, a.item_id, a.playtime_forever, a.playtime_2weeks,
         avg(a.playtime_forever) OVER (PARTITION BY a.item_id) AS global_avg_playtime,
         ln(1 + a.playtime_forever / avg(a.playtime_forever) OVER (PARTITION BY a.item_id))
           AS implicit_preference_score,
         p.p_name AS item_name, concat_ws(' ', p.p_brand, p.p_type) AS profile_tag
  FROM act a LEFT JOIN part p ON a.item_id = p.p_partkey)"""


def slug_sql(x: str) -> str:
    return (f"regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]', '_', 'g'), "
            f"'_{{2,}}', '_', 'g')")


def link_key_sql(x: str) -> str:
    return f"nullif(regexp_replace(lower({x}), '[^a-z0-9]', '', 'g'), '')"


USER_TAGS = INTER + f""",
ut AS (SELECT DISTINCT user_id, {slug_sql('profile_tag')} AS tag FROM inter WHERE profile_tag IS NOT NULL)"""

COHORTS = USER_TAGS + """,
coh AS (SELECT u.user_id, c.c_mktsegment AS cohort_id
        FROM (SELECT DISTINCT user_id FROM inter) u JOIN customer c ON u.user_id = c.c_custkey)"""

# Fixed values, written again so that the SQL does not depend on the code under test.
_STOP = """'open_world', 'steam_trading_cards', 'singleplayer', 'multiplayer', 'indie', 'action',
    'steam_achievements', 'free_to_play', 'adventure', 'simulator', 'simulation', 'strategy', 'rpg', 'co_op',
    'casual', 'steam', 'party', 'early_access', 'atmospheric', '2d', '3d'"""
_PATTERN = ("controller|support|steam|remote|play|share|schermo|partida|partage"
            "|screen|speech|text|lang|audio|achievements")


def lift_sql(min_users: int, min_share: float) -> str:
    return COHORTS + f""",
j AS (SELECT ut.user_id, ut.tag, coh.cohort_id FROM ut JOIN coh USING (user_id)),
tot AS (SELECT count(*) AS n FROM coh),
g AS (SELECT tag, count(*) AS global_tag_users,
             count(*)::DOUBLE / (SELECT n FROM tot) AS global_prop FROM j GROUP BY tag),
sz AS (SELECT cohort_id, count(*) AS cohort_size FROM coh GROUP BY cohort_id),
pc AS (SELECT cohort_id, tag, count(*) AS cohort_tag_users FROM j GROUP BY cohort_id, tag),
lift AS (
  SELECT pc.cohort_id, pc.tag, pc.cohort_tag_users, sz.cohort_size, g.global_tag_users, g.global_prop,
         pc.cohort_tag_users::DOUBLE / sz.cohort_size AS cohort_prop,
         (pc.cohort_tag_users::DOUBLE / sz.cohort_size) / g.global_prop AS lift
  FROM pc JOIN sz USING (cohort_id) JOIN g USING (tag)),
best AS (
  SELECT cohort_id, tag, row_number() OVER (PARTITION BY cohort_id
           ORDER BY lift DESC, cohort_prop DESC, tag ASC) AS rnk
  FROM lift
  WHERE global_tag_users >= {min_users} AND cohort_prop >= {min_share}
    AND tag NOT IN ({_STOP}) AND NOT regexp_matches(tag, '{_PATTERN}', 'i')),
names AS (
  SELECT cohort_id, 'Cluster ' || cohort_id || ' (' || string_agg(tag, ' & ' ORDER BY rnk) || ' Fans)'
           AS cohort_name
  FROM best WHERE rnk <= 2 GROUP BY cohort_id),
lab AS (SELECT coh.user_id, coh.cohort_id, coalesce(names.cohort_name, 'Unknown Cluster') AS cohort_name
        FROM coh LEFT JOIN names USING (cohort_id))"""


def scores_sql(min_users: int, min_share: float, min_score: float, max_share: float,
               exponent: float = 1.2) -> str:
    return lift_sql(min_users, min_share) + f""",
pop AS (SELECT item_id, count(*) AS user_count, sum(s) AS global_score
        FROM (SELECT item_id, user_id, sum(implicit_preference_score) AS s
              FROM inter GROUP BY item_id, user_id) GROUP BY item_id),
tu AS (SELECT count(DISTINCT user_id) AS n FROM inter),
pcs AS (SELECT lab.cohort_id, i.item_id, sum(i.implicit_preference_score) AS cohort_score,
               max(i.item_name) AS item_name
        FROM inter i JOIN lab USING (user_id) GROUP BY lab.cohort_id, i.item_id),
cs AS (SELECT pcs.*, pop.user_count, pop.global_score,
              pow(pcs.cohort_score, {exponent}) / ln(1 + pop.global_score) AS game_cluster_score
       FROM pcs JOIN pop USING (item_id)
       WHERE pop.user_count < {max_share} * (SELECT n FROM tu) AND pcs.cohort_score > {min_score})"""


def reco_sql(min_users, min_share, min_score, max_share, per_cohort, per_user) -> str:
    return scores_sql(min_users, min_share, min_score, max_share) + f""",
top AS (SELECT * FROM (SELECT cs.*, row_number() OVER (PARTITION BY cohort_id
                         ORDER BY game_cluster_score DESC, item_id ASC) AS cohort_rank FROM cs)
        WHERE cohort_rank <= {per_cohort}),
cand AS (SELECT lab.user_id, lab.cohort_id, lab.cohort_name, top.item_id, top.item_name,
                top.game_cluster_score
         FROM lab JOIN top USING (cohort_id)),
fresh AS (SELECT * FROM cand c WHERE NOT EXISTS (
            SELECT 1 FROM inter i WHERE i.user_id = c.user_id AND i.item_id = c.item_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id
             ORDER BY game_cluster_score DESC, item_id ASC) AS reco_rank FROM fresh
           QUALIFY reco_rank <= {per_user})"""


ITEM_TAGS = """tags AS (
  SELECT DISTINCT id, name, tag FROM (
    SELECT p_partkey AS id, p_name AS name, unnest(string_split(p_name, ' ')) AS tag FROM part
    UNION ALL SELECT p_partkey, p_name, p_brand FROM part
    UNION ALL SELECT p_partkey, p_name, p_type FROM part)),
freq AS (SELECT tag, count(*) AS n_items FROM tags GROUP BY tag)"""


def similarity_sql(cap: int | None, k: int, basis: str, final_select: str | None = None) -> str:
    """Top-k tag neighbours; ``final_select`` replaces the last SELECT (it can
    read ``ranked``: id, nbr_id, nbr_name, shared, score, rank)."""
    sizes_from = "tags" if basis == "all" else "kept0"
    within = "true" if cap is None else f"f.n_items <= {cap}"
    return f"""WITH {ITEM_TAGS},
kept0 AS (SELECT t.* FROM tags t JOIN freq f USING (tag) WHERE {within} AND t.tag IS NOT NULL),
sizes AS (SELECT id, count(*) AS n_tags FROM {sizes_from} GROUP BY id),
kept AS (SELECT k.id, k.name, k.tag, s.n_tags FROM kept0 k JOIN sizes s USING (id)),
pairs AS (SELECT a.id, b.id AS nbr_id, b.name AS nbr_name, a.n_tags AS a_n, b.n_tags AS b_n,
                 count(*) AS shared
          FROM kept a JOIN kept b ON a.tag = b.tag AND a.id <> b.id
          GROUP BY a.id, b.id, b.name, a.n_tags, b.n_tags),
ranked AS (SELECT id, nbr_id, nbr_name, shared,
                  shared::DOUBLE / (a_n + b_n - shared) AS score,
                  row_number() OVER (PARTITION BY id ORDER BY shared::DOUBLE / (a_n + b_n - shared) DESC,
                                     nbr_name ASC NULLS FIRST, nbr_id ASC) AS rank
           FROM pairs)
""" + (final_select or f"""SELECT id, rank::INTEGER AS rank, nbr_id, nbr_name, shared, round(score, 6) AS score
FROM ranked WHERE rank <= {k}""")
