from pyspark.sql import functions as F

from playlens.operators.features import tfidf_features


def test_no_tag_of_a_large_vocabulary_is_dropped(spark):
    n = 262_144 + 500  # beyond CountVectorizer's default
    users = spark.range(n // 500 + 1).select(F.transform(
        F.sequence(F.lit(0), F.lit(499)), lambda i: F.concat(F.lit("t"), F.col("id") * 500 + i)).alias("all_tags"))
    model, _ = tfidf_features(users, min_df=1)
    assert len(model.stages[0].vocabulary) == (n // 500 + 1) * 500 > 262_144
