"""Operators against plain-Python brute force on random fixtures."""

import random

import pytest

from playlens.operators import recommend as rec
from playlens.operators import similarity as sim

ITEMS = "igdb_id long, igdb_name string, genre_names array<string>, theme_names array<string>, tag_names array<string>"


def _brute_similarity(items, k, cap, basis):
    tags = {i: set(g or []) | set(t or []) | set(x or []) for i, _, g, t, x in items}
    names = {i: n for i, n, *_ in items}
    freq = {}
    for ts in tags.values():
        for t in ts:
            freq[t] = freq.get(t, 0) + 1
    kept = {i: {t for t in ts if freq[t] <= cap} for i, ts in tags.items()}
    size = {i: len(tags[i]) if basis == "all" else len(kept[i]) for i in tags}
    out = []
    for a in tags:
        cands = []
        for b in tags:
            if a == b:
                continue
            inter = len(kept[a] & kept[b])
            if inter:
                name_key = (0, "") if names[b] is None else (1, names[b])   # NULL names first
                cands.append((-(inter / (size[a] + size[b] - inter)), name_key, b))
        for rank, (s, _, b) in enumerate(sorted(cands)[:k], 1):
            out.append((a, rank, b, round(-s, 9)))
    return sorted(out)


@pytest.mark.parametrize("seed,basis", [(1, "all"), (2, "kept"), (3, "all")])
def test_similarity_matches_brute_force(spark, seed, basis):
    rnd = random.Random(seed)
    vocab = [f"t{i}" for i in range(12)]
    items = []
    for i in range(60):
        pick = lambda n: rnd.sample(vocab, rnd.randint(0, n)) or None
        items.append((i, rnd.choice(["a", "b", "c", None]), pick(3), pick(2), pick(2)))
    df = spark.createDataFrame(items, ITEMS)
    got = sim.tag_similarity(df, k=4, max_tag_freq=15, size_basis=basis)
    got = sorted((r.id, r.rank, r.nbr_id, round(r.score, 9)) for r in got.collect())
    assert got == _brute_similarity(items, 4, 15, basis)


def _brute_recommend(inter, cohorts, min_score, max_share, per_cohort, per_user):
    import math
    users = {u for u, *_ in inter}
    owned = {(u, i) for u, i, _ in inter}
    pop, glob = {}, {}
    for u, i, s in inter:
        pop.setdefault(i, set()).add(u)
        glob[i] = glob.get(i, 0.0) + s
    cs = {}
    for u, i, s in inter:
        cs[(cohorts[u], i)] = cs.get((cohorts[u], i), 0.0) + s
    scores = {}
    for (c, i), v in cs.items():
        if v > min_score and len(pop[i]) < max_share * len(users):
            scores.setdefault(c, []).append((-(v ** 1.2 / math.log1p(glob[i])), i))
    top = {c: sorted(v)[:per_cohort] for c, v in scores.items()}
    out = []
    for u in sorted(users):
        fresh = [(s, i) for s, i in top.get(cohorts[u], []) if (u, i) not in owned]
        for rank, (s, i) in enumerate(sorted(fresh)[:per_user], 1):
            out.append((u, rank, i))
    return out


@pytest.mark.parametrize("seed", [5, 6])
def test_recommend_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    inter = {}
    for _ in range(400):
        u, i = f"u{rnd.randint(0, 39)}", rnd.randint(0, 29)
        inter[(u, i)] = round(rnd.uniform(0.1, 3.0), 3)
    rows = [(u, i, s) for (u, i), s in inter.items()]
    cohorts = {u: rnd.randint(0, 3) for u, _, _ in rows}
    df = spark.createDataFrame([(u, i, f"n{i}", s) for u, i, s in rows],
                               "steam_id string, steam_appid long, game_name string, implicit_preference_score double")
    lab = spark.createDataFrame([(u, c, f"c{c}") for u, c in cohorts.items()],
                                "steam_id string, cohort_id int, cohort_name string")
    got = rec.recommend(df, lab, min_score=2.0, max_share=0.3, per_cohort=5, per_user=3, n_cohorts=4)
    got = sorted((r.steam_id, r.reco_rank, r.steam_appid) for r in got.collect())
    assert got == sorted(_brute_recommend(rows, cohorts, 2.0, 0.3, 5, 3))
