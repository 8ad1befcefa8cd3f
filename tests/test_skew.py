"""With a key that holds a third of all rows and no broadcasts, Spark splits the hot partition."""

import pytest
from pyspark.sql import functions as F

from venuekit.operators import joins
from venuekit.plans import recommend, sentiment, topics
from venuekit.sources.scratch import materialise

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def shuffled(spark):
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name in SETTINGS:
        spark.conf.unset(name)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture(scope="module")
def tables(spark, shuffled):
    n = 60_000
    reviews = (
        spark.range(n)
        .select(
            F.md5(F.col("id").cast("string")).alias("ReviewID"),
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("UserID"),
            F.when(F.col("id") % 3 == 1, 1).otherwise(F.hash("id") % 2000).cast("long").alias("BusinessID"),
            (F.col("id") % 5).alias("ReviewStars"),
            F.lit("2018-01-01").cast("date").alias("Date"),
            F.concat(F.lit("hot "), F.md5(F.concat(F.lit("x"), "id"))).alias("Review"),
            F.sha2(F.col("id").cast("string"), 512).alias("useful"),
        )
        .repartition(8)
    )
    users = spark.range(5000).select(
        F.col("id").alias("UserID"), F.lit("n").alias("UserName"), F.lit(1).alias("ReviewCount"), F.lit(3.0).alias("AverageStars")
    )
    places = spark.range(2000).select(
        F.col("id").alias("BusinessID"),
        F.lit("N").alias("Name"),
        F.lit("X").alias("City"),
        F.lit("M5V 1A1").alias("PostalCode"),
        F.lit("M5V").alias("ZipCode"),
        *[F.lit("1").alias(c) for c in ("Latitude", "Longitude", "avg_neg", "avg_neu", "avg_pos", "avg_composite_score")],
    )
    lexicon = spark.createDataFrame([("hot", 1.0)], "token string, valence double")
    return reviews, users, places, lexicon


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _counts(reviews):
    """Words per business, of which one word is in a third of all rows."""
    term = F.when(F.col("UserID") == 0, "hot").otherwise(F.col("UserID").cast("string")).alias("term")
    counts = reviews.select(F.col("ReviewID").alias("BusinessID"), term, F.lit(1).alias("n"))
    words = counts.select("term").distinct().select("term", F.hash("term").alias("index"), F.lit(0.5).alias("idf"))
    return counts, materialise(words, "words")


def _asking(reviews):
    """Users of whom a third are in one cell, and the ranked list of each cell."""
    cell = F.when(F.col("UserID") == 0, "hot").otherwise(F.col("UserID").cast("string")).alias("_cell")
    asking = reviews.select(F.col("ReviewID").alias("UserID"), cell, F.lit(1).alias("_chunks"))
    ranked = asking.select("_cell").distinct().select("_cell", F.lit(1).alias("_place"), F.lit(7).alias("BusinessID"))
    return asking, ranked


CASES = {
    "lists of a cell": lambda r, u, b, x: recommend.first_places(*_asking(r)),
    "present_in": lambda r, u, b, x: joins.present_in(r, "BusinessID", b, "BusinessID"),
    "absent_from": lambda r, u, b, x: joins.absent_from(r, ["BusinessID"], b.where("BusinessID % 2 = 0")),
    "city reviews": lambda r, u, b, x: sentiment.with_texts(
        sentiment.city_scores(r, b, x, "X"), r, b, "X"
    ),
    "semi join of texts": lambda r, u, b, x: topics.business_texts(r, b),
    "training rows": lambda r, u, b, x: recommend.training_features(r, u, b),
    "review scores": lambda r, u, b, x: sentiment.review_scores(r, x),
    "business scores": lambda r, u, b, x: sentiment.business_means(
        sentiment.city_scores(r, b, x, "X"), b, "X"
    ),
    "terms of a business": lambda r, u, b, x: topics.weighted_terms(*_counts(r)),
    "term weights": lambda r, u, b, x: topics.tfidf(topics.term_counts(r, "ReviewID", "Review"), r),
}


@pytest.mark.parametrize("name", CASES)
def test_hot_key_is_split(tables, name):
    assert "skew=true" in final_plan(CASES[name](*tables))


def test_a_hot_key_on_the_other_side_is_folded_first(spark, tables):
    reviews, users, _, _ = tables
    kept = joins.present_in(users, "UserID", reviews, "UserID")
    physical = kept._jdf.queryExecution().executedPlan().toString()
    assert physical.count("HashAggregate") == 2  # before and after the shuffle
    assert kept.count() == reviews.select("UserID").distinct().count()


def test_words_of_a_hot_business_are_dealt_out(spark, tables):
    """Words go by review: a join of reviews and businesses does not leave those of one business in one task."""
    reviews = tables[0].withColumn("BusinessID", F.col("BusinessID") % 2)
    places = spark.range(200_000).select(F.col("id").alias("BusinessID"), F.lit("N").alias("City"))
    lexicon = spark.sql("select * from values ('hot', 1.5D) as t(token, valence)")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "1MB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in settings.items():  # the lexicon is broadcast, the businesses are not
        spark.conf.set(name, value)
    try:
        scores = sentiment.city_scores(reviews, places, lexicon, None)
        tasks = scores.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("Over_all")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["n"] for r in tasks) == scores.count() and len(tasks) == 16
