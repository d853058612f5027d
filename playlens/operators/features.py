"""User tag profiles, TF-IDF and learned cohorts.

The relational form ``(user, tag, tf)`` is the primary representation: it is
what the cohort analytics consume and what the SQL oracle checks.  The MLlib
path (CountVectorizer -> IDF -> Normalizer -> KMeans) only runs to *assign*
cohorts; ``tfidf`` is its exact relational twin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions.scalar import slug, unify_tags
from playlens.session import materialize


def user_tag_counts(interactions: DataFrame, user: str = "steam_id",
                    tag_cols: Sequence[str] = ("genre_names", "theme_names", "tag_names"),
                    dedupe_after_slug: bool = True) -> DataFrame:
    """``(user, tag, tf)``: slugged tags a user's items carry.

    With ``dedupe_after_slug`` (default) two spellings of one tag count once
    (``tf`` is 1).  ``False`` de-duplicates raw spellings first, so
    ``"Co-op"`` and ``"co op"`` give ``co_op`` with ``tf`` 2, as the reference
    does.  NULL tags are dropped.
    """
    raw = (interactions.select(F.col(user), F.explode(unify_tags(*tag_cols)).alias("raw"))
           .filter(F.col("raw").isNotNull()))
    if dedupe_after_slug:
        return (raw.select(user, slug(F.col("raw")).alias("tag")).distinct()
                .withColumn("tf", F.lit(1).cast("long")))
    return (raw.distinct().select(user, slug(F.col("raw")).alias("tag"))
            .groupBy(user, "tag").agg(F.count(F.lit(1)).alias("tf")))


def user_tag_arrays(counts: DataFrame, users: DataFrame, user: str = "steam_id") -> DataFrame:
    """One sorted tag array per user (tags repeated ``tf`` times), the input
    shape of CountVectorizer.  Users without tags get an empty array.

    A list holds at most (vocabulary x tf) entries per user, independent of
    how many interactions the user has.
    """
    arrs = counts.groupBy(user).agg(F.sort_array(F.flatten(F.collect_list(
        F.array_repeat(F.col("tag"), F.col("tf").cast("int"))))).alias("all_tags"))
    base = users.select(user).distinct()
    return base.join(arrs, user, "left").select(
        user, F.coalesce("all_tags", F.array().cast("array<string>")).alias("all_tags"))


def tfidf(counts: DataFrame, users: DataFrame, user: str = "steam_id", min_df: int = 5) -> DataFrame:
    """Relational TF-IDF with L2 normalisation: ``(user, tag, tf, df, idf, weight)``.

    Same numbers as CountVectorizer(minDF) -> IDF -> Normalizer(p=2):
    ``idf = ln((m + 1) / (df + 1))`` with ``m`` the number of users
    (documents, including users without tags).  A user whose weights are all
    zero keeps zero weights.  The vocabulary is not size-capped.
    """
    m = users.select(user).distinct().agg(F.count(F.lit(1))).scalar()
    df_ = counts.groupBy("tag").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_df)
    w = (counts.join(df_, "tag")
         .withColumn("idf", F.log((m + F.lit(1.0)) / (F.col("df") + F.lit(1.0))))
         .withColumn("w", F.col("tf") * F.col("idf")))
    norms = w.groupBy(user).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return (w.join(norms, user)
            .withColumn("weight", F.when(F.col("norm") > 0, F.col("w") / F.col("norm"))
                        .otherwise(F.lit(0.0)))
            .drop("w", "norm"))


def tfidf_features(arrays: DataFrame, min_df: int = 5, input_col: str = "all_tags"):
    """MLlib feature path; returns ``(fitted pipeline model, features frame)``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, CountVectorizer, Normalizer

    # the default vocabulary drops the rarest tags beyond 262,144 of them
    tags = arrays.select(F.explode(F.array_distinct(input_col)).alias("tag"))
    size = tags.groupBy("tag").count().where(F.col("count") >= min_df).count()
    pipe = Pipeline(stages=[
        CountVectorizer(inputCol=input_col, outputCol="raw_features", minDF=float(min_df), vocabSize=max(1, size)),
        IDF(inputCol="raw_features", outputCol="features_raw"),
        Normalizer(inputCol="features_raw", outputCol="features", p=2.0),
    ])
    model = pipe.fit(arrays)
    return model, model.transform(arrays)


def assign_cohorts(arrays: DataFrame, user: str = "steam_id", k: int = 30, seed: int = 42,
                   min_df: int = 5, distance: str = "euclidean", max_iter: int = 20):
    """TF-IDF features + K-Means.  Returns ``(assignments, predictions)``.

    ``assignments`` is ``(user, cohort_id)``.  With ``distance="cosine"``
    users with an all-zero vector are dropped first (cosine K-Means cannot
    place them).  K-Means is iterative and seeded; results depend on data
    order, so tests check invariants, not exact labels.
    """
    return learn_cohorts(arrays, user, k, seed, min_df, distance, max_iter)[:2]


def learn_cohorts(arrays: DataFrame, user: str = "steam_id", k: int = 30, seed: int = 42,
                  min_df: int = 5, distance: str = "euclidean", max_iter: int = 20):
    """As ``assign_cohorts``, with the learned centres as a third frame
    ``(cohort_id, tag, value)`` of their values that aren't zero."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import vector_to_array

    # the vocabulary, the idf, the centres and each reader of the cohorts would build them again
    features, feats = tfidf_features(materialize(arrays, "tag-arrays"), min_df=min_df)
    feats = materialize(feats.select(user, "features"), "features")
    if distance == "cosine":
        feats = feats.filter(F.aggregate(vector_to_array("features"), F.lit(0.0),
                                         lambda acc, x: acc + F.abs(x)) > 0)
    km = KMeans(k=k, seed=seed, maxIter=max_iter, distanceMeasure=distance,
                featuresCol="features", predictionCol="cohort_id")
    model = km.fit(feats)
    pred = materialize(model.transform(feats), "cohorts")
    # the library holds the centres in the driver, k times the vocabulary
    words = features.stages[0].vocabulary
    values = [(c, words[i], float(x)) for c, centre in enumerate(model.clusterCenters()) for i, x in enumerate(centre) if x]
    centres = arrays.sparkSession.createDataFrame(values, "cohort_id int, tag string, value double")
    return pred.select(user, F.col("cohort_id").cast("int").alias("cohort_id")), pred, centres


def nearer_elsewhere(weights: DataFrame, assign: DataFrame, centres: DataFrame, user: str = "steam_id",
                     tolerance: float = 1e-6) -> DataFrame:
    """Users with a centre that is nearer than their own cohort's by more than ``tolerance``.

    ``weights`` holds each user's vector as ``(user, tag, weight)`` rows.  The squared distance to a
    centre, less the user's own square, is |centre|^2 - 2 dot; a centre that
    shares no tag with the user has dot 0.
    """
    norms = centres.groupBy("cohort_id").agg(F.sum(F.col("value") * F.col("value")).alias("square"))
    dots = (weights.select(user, "tag", "weight").join(centres, "tag").groupBy(user, "cohort_id")
            .agg(F.sum(F.col("weight") * F.col("value")).alias("dot")).join(norms, "cohort_id")
            .select(user, "cohort_id", (F.col("square") - 2 * F.col("dot")).alias("far")))
    own = (assign.join(dots, [user, "cohort_id"], "left").join(norms, "cohort_id", "left")
           .select(user, F.coalesce("far", "square", F.lit(0.0)).alias("own")))
    least = dots.groupBy(user).agg(F.min("far").alias("least"))
    empty = norms.agg(F.min("square")).scalar()
    return (own.join(least, user, "left")
            .where(F.col("own") > F.least(F.coalesce("least", empty), empty) + tolerance).select(user))


def cohort_silhouette(weights: DataFrame, assign: DataFrame, user: str = "steam_id") -> DataFrame:
    """M5 in closed form: ``(user, cohort_id, silhouette)`` by cosine distance.

    The mean distance of a unit vector to a cohort is 1 - dot(vector, sum of the
    cohort's vectors) / size, so the sums per cohort and tag (k times the
    vocabulary) stand for all pairs of users.  Within the own cohort the user
    itself is left out; a cohort of one has silhouette 0.  A user without
    weights is at distance 1 from every cohort.
    """
    sizes = assign.groupBy("cohort_id").agg(F.count(F.lit(1)).alias("size"))
    unit = weights.select(user, "tag", "weight")
    sums = (unit.join(assign, user).groupBy("cohort_id", "tag").agg(F.sum("weight").alias("total"))
            .join(sizes, "cohort_id").select("tag", F.col("cohort_id").alias("c"), "size", "total"))
    far = (unit.join(sums, "tag").groupBy(user, "c").agg(F.sum(F.col("weight") * F.col("total")).alias("dot"), F.max("size").alias("size"))
           .select(user, "c", (1 - F.col("dot") / F.col("size")).alias("far")))
    mine = F.col("c") == F.col("cohort_id")
    per = (assign.join(far, user, "left").groupBy(user, "cohort_id")
           .agg(F.max(F.when(mine, F.col("far"))).alias("a"), F.min(F.when(~mine, F.col("far"))).alias("b"))
           .join(sizes, "cohort_id"))
    a = F.coalesce("a", F.lit(1.0)) * F.col("size") / (F.col("size") - 1)
    per = per.select(user, "cohort_id", "size", F.when(F.col("size") > 1, a).alias("a"), F.coalesce("b", F.lit(1.0)).alias("b"))
    value = F.when((F.col("size") == 1) | (F.greatest("a", "b") == 0), F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return per.select(user, "cohort_id", value.alias("silhouette"))


def cohort_quality(predictions: DataFrame, cohort_col: str = "cohort_id") -> float:
    """M5: cosine silhouette of an assignment (an action; value in [-1, 1])."""
    from pyspark.ml.evaluation import ClusteringEvaluator

    ev = ClusteringEvaluator(predictionCol=cohort_col, featuresCol="features",
                             metricName="silhouette", distanceMeasure="cosine")
    return float(ev.evaluate(predictions))
