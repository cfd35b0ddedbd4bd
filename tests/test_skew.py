"""One key holding a third of the rows or more, with joins that cannot be broadcast."""

import pytest
from pyspark.sql import functions as F

from platewise.operators import keys, matrix, repeats, reports

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB",
}


@pytest.fixture
def shuffled_joins(spark):
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_ratings(spark, rows=60_000):
    """Every third row rates one meal; users are many."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, rows, 1, 6).select(
        F.format_string("u%05d", "id").alias("UserID"),
        F.when(hot, "hot").otherwise(F.format_string("m%04d", F.col("id") % 997)).alias("MealID"),
        (1 + F.col("id") % 5).cast("double").alias("Rating"),
        F.sha2(F.col("id").cast("string"), 256).alias("Review"),
        F.col("id").alias("ReviewTime"),
    )


def final_plan(df):
    """The executed plan; only its adapted parts can say ``skew=true``."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def names(spark):
    listed = spark.range(997).select(F.format_string("m%04d", "id").alias("mealID"), F.col("id").cast("int").alias("mealno"))
    listed = listed.unionByName(spark.range(1).select(F.lit("hot").alias("mealID"), F.lit(997).alias("mealno")))
    return listed.withColumn("meal_name", F.concat(F.lit("name "), "mealID"))


def test_encoding_splits_the_hot_meal(spark, shuffled_joins):
    ratings = hot_ratings(spark)
    users = keys.dense_index(ratings, "UserID", "UserIndex")
    meals = keys.dense_index(ratings, "MealID", "MealIndex")
    cleaned = keys.encode(ratings, users, meals, names(spark))
    assert "skew=true" in final_plan(cleaned)
    assert cleaned.count() == 60_000
    assert cleaned.agg(F.countDistinct("UserIndex")).first()[0] == 60_000
    assert cleaned.filter("meal_name = 'name hot'").count() == 20_000


def test_vectors_split_the_hot_meal(spark, shuffled_joins):
    cells = hot_ratings(spark).select("UserID", "MealID", "Rating")
    vectors = matrix.vector_rows(cells, matrix.meal_positions(cells))
    assert "skew=true" in final_plan(vectors)
    assert vectors.count() == 60_000


def test_well_rated_cells_split_the_hot_meal(spark, shuffled_joins):
    ratings = hot_ratings(spark).withColumn("mealno", F.lit(1))
    cells = matrix.rating_cells(ratings, min_avg_rating=0.5)
    assert "skew=true" in final_plan(cells)
    assert cells.count() == 60_000


def test_repeats_split_the_hot_pair(spark, shuffled_joins):
    """20,000 different rows of one pair: the semi-join and the aggregate over it share the key."""
    ratings = hot_ratings(spark).withColumn("UserID", F.when(F.col("MealID") == "hot", "hot").otherwise(F.col("UserID")))
    again = repeats.repeat_ratings(ratings)
    assert again.count() == 19_999
    assert again.filter(F.col("ReviewTime") == 0).count() == 0


def test_counts_shrink_before_the_shuffle(spark):
    counted = reports.count_by(hot_ratings(spark), "MealID")
    plan = final_plan(counted)
    assert plan.split("Initial Plan")[0].count("HashAggregate") == 2
    assert {r["count"] for r in counted.filter("MealID = 'hot'").collect()} == {20_000}
