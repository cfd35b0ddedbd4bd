"""Counts, shares, extremes and top lists over the raw ratings.

Every aggregate here combines on the map side, so a rating, meal or review that holds a third of
all rows reaches the reducers as a few rows per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.functions.columns import percent
from platewise.session import stage


def count_by(ratings: DataFrame, *keys: str) -> DataFrame:
    return ratings.groupBy(*keys).count()


def meal_rating_rows(ratings: DataFrame) -> DataFrame:
    """Rows per (Rating, MealID): small, and enough for every report below but the plain counts."""
    return ratings.groupBy("Rating", "MealID").agg(F.count("*").alias("rows"))


def _share(counts: DataFrame) -> DataFrame:
    # Both uses of the counts are the same aggregate, so its shuffle is reused.
    total = counts.agg(F.sum("rows")).scalar()
    rated = F.when(F.col("Rating").isNull(), F.lit(0).cast("bigint")).otherwise(F.col("rows"))
    return counts.select("Rating", rated.alias("sum")).withColumn("weights", percent(F.col("sum"), total))


def _meal_counts(rows: DataFrame) -> DataFrame:
    counted = F.when(F.col("MealID").isNull(), F.lit(0).cast("bigint")).otherwise(F.col("rows"))
    return rows.select("Rating", "MealID", counted.alias("Count"))


def _most(rows: DataFrame, meals: DataFrame) -> DataFrame:
    best = (
        _meal_counts(rows.filter(F.col("MealID").isNotNull()))
        .groupBy("Rating")
        .agg(
            F.max("Count").alias("MaxCount"),
            F.max_by("MealID", F.struct("Count", "MealID")).alias("MealID"),
        )
    )
    return best.join(meals, "MealID")


def _least(rows: DataFrame, meals: DataFrame) -> DataFrame:
    least = (
        _meal_counts(rows.filter(F.col("MealID").isNotNull()))
        .groupBy("Rating")
        .agg(
            F.min("Count").alias("MinCount"),
            F.min_by("MealID", F.struct("Count", "MealID")).alias("MealID"),
        )
    )
    return least.join(meals, "MealID")


def _top_with_names(counts: DataFrame, measure: str, meals: DataFrame, n: int) -> DataFrame:
    """First ``n`` by ``measure``, then names: a meal missing from the list shortens the report.

    The broadcast side has ``n`` rows, so the meal list is streamed and never shuffled.
    """
    top = counts.orderBy(F.desc(measure), "MealID").limit(n)
    return F.broadcast(top).join(meals, "MealID").orderBy(F.desc(measure), "MealID")


def rating_share(ratings: DataFrame) -> DataFrame:
    """Rows per rating and their percentage of all rows.

    Rows without a rating count in the total and show as a group of 0, as a count of the rating
    column gives it.
    """
    return _share(ratings.groupBy("Rating").agg(F.count("*").alias("rows")))


def meal_counts_per_rating(ratings: DataFrame) -> DataFrame:
    """Ratings per (Rating, MealID); rows without a meal count 0."""
    return _meal_counts(meal_rating_rows(ratings))


def top_meal_per_rating(ratings: DataFrame, meals: DataFrame) -> DataFrame:
    """The most frequent meal of each rating; among equals the last MealID in text order.

    Rows without a meal take no part, here and in the least frequent one: there is no meal to name.
    """
    return _most(meal_rating_rows(ratings), meals)


def bottom_meal_per_rating(ratings: DataFrame, meals: DataFrame) -> DataFrame:
    """The least frequent meal of each rating; among equals the first MealID in text order."""
    return _least(meal_rating_rows(ratings), meals)


def top_sales(ratings: DataFrame, meals: DataFrame, n: int = 10) -> DataFrame:
    """Meals with the most ratings."""
    return _top_with_names(ratings.groupBy("MealID").agg(F.count("*").alias("Sales")), "Sales", meals, n)


def top_rated(ratings: DataFrame, meals: DataFrame, rating: float = 5.0, n: int = 10) -> DataFrame:
    """Meals with the most ratings of exactly ``rating``."""
    counts = meal_counts_per_rating(ratings.filter(F.col("Rating") == F.lit(rating)))
    return _top_with_names(counts, "Count", meals, n)


def all_reports(ratings: DataFrame, meals: DataFrame, rating: float = 5.0, n: int = 10) -> dict[str, DataFrame]:
    """The five report files by name, from a single pass over the ratings.

    Rows per (rating, meal) are counted once and staged; each report sums them up further.
    """
    rows = stage(meal_rating_rows(ratings), "meal-rating-rows")
    sales = rows.groupBy("MealID").agg(F.sum("rows").alias("Sales"))
    rated = _meal_counts(rows.filter(F.col("Rating") == F.lit(rating)))
    return {
        "RatingType": _share(rows.groupBy("Rating").agg(F.sum("rows").alias("rows"))),
        "result2": _most(rows, meals),
        "result3": _least(rows, meals),
        "top10": _top_with_names(sales, "Sales", meals, n),
        "RatingTop10": _top_with_names(rated, "Count", meals, n),
    }


def row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """One row (stage, rows) per frame."""
    counted = [
        frame.agg(F.count("*").alias("rows")).select(F.lit(stage).alias("stage"), "rows")
        for stage, frame in stages.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def counted_rows(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """The same rows from counts taken while the frames were written."""
    return spark.createDataFrame(list(counts.items()), "stage string, rows bigint")
