import math

from playlens.operators import features as feat


def _interactions(spark):
    data = []
    for u in range(12):
        tags = ["Action", "co op" if u % 2 else "Co-op", f"T{u % 3}", "Rare" if u == 0 else "Action"]
        data.append((f"u{u}", tags))
    data.append(("u_empty", None))
    return spark.createDataFrame(data, "steam_id string, tag_names array<string>")


def test_dedupe_after_slug(spark):
    df = spark.createDataFrame([("u", ["Co-op", "co op"])], "steam_id string, tag_names array<string>")
    assert feat.user_tag_counts(df, tag_cols=["tag_names"]).collect()[0].tf == 1
    raw = feat.user_tag_counts(df, tag_cols=["tag_names"], dedupe_after_slug=False).collect()
    assert [(r.tag, r.tf) for r in raw] == [("co_op", 2)]


def test_relational_tfidf_matches_mllib(spark):
    inter = _interactions(spark)
    counts = feat.user_tag_counts(inter, tag_cols=["tag_names"])
    rel = {(r.steam_id, r.tag): r.weight for r in feat.tfidf(counts, inter, min_df=2).collect()}
    arrays = feat.user_tag_arrays(counts, inter)
    model, feats = feat.tfidf_features(arrays, min_df=2)
    vocab = model.stages[0].vocabulary
    seen = 0
    for r in feats.collect():
        v = r.features
        for i, w in zip(v.indices, v.values):
            assert math.isclose(rel[(r.steam_id, vocab[i])], w, abs_tol=1e-9)
            seen += 1
    assert seen == sum(1 for w in rel.values() if w != 0)
    assert "rare" not in vocab  # below min_df


def test_kmeans_invariants(spark):
    inter = _interactions(spark)
    arrays = feat.user_tag_arrays(feat.user_tag_counts(inter, tag_cols=["tag_names"]), inter)
    assign, pred = feat.assign_cohorts(arrays, k=3, seed=42, min_df=2)
    got = assign.collect()
    assert len(got) == 13 and {r.cohort_id for r in got} <= {0, 1, 2}
    assert -1.0 <= feat.cohort_quality(pred) <= 1.0
    cos, _ = feat.assign_cohorts(arrays, k=2, seed=42, min_df=2, distance="cosine")
    assert "u_empty" not in {r.steam_id for r in cos.collect()}
