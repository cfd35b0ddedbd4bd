"""Users who rated the same meal more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.functions.columns import review_date
from platewise.session import stage

PAIR = ["UserID", "MealID"]


def _others(ratings: DataFrame) -> list[str]:
    """Every column that is neither in the pair nor the time: the tie-breaks, in a fixed order."""
    fixed = {name.lower() for name in [*PAIR, "ReviewTime"]}
    return [name for name in ratings.columns if name.lower() not in fixed]


def latest_ratings(ratings: DataFrame) -> DataFrame:
    """Each user's newest rating of each meal.

    Spark keeps only the first row of a pair in every map task before it shuffles
    (WindowGroupLimit), so a pair that holds a third of all rows sends one row per task.
    """
    newest = Window.partitionBy(*PAIR).orderBy(
        F.desc("ReviewTime"), *[F.desc(name) for name in _others(ratings)]
    )
    return ratings.withColumn("rank", F.row_number().over(newest)).filter("rank = 1").drop("rank")


def duplicate_pairs(ratings: DataFrame) -> DataFrame:
    """(UserID, MealID) pairs with more than one row, and how many."""
    return ratings.groupBy(*PAIR).agg(F.count("*").alias("Count")).filter(F.col("Count") > 1)


def duplicate_total(ratings: DataFrame) -> DataFrame:
    """Rows that belong to such pairs, as one row; NULL when there are none."""
    return duplicate_pairs(ratings).agg(F.sum("Count").alias("total"))


def _same_pair(left: DataFrame, right: DataFrame) -> Column:
    """Rows without a user or meal form groups of their own, so NULL matches NULL."""
    return left["UserID"].eqNullSafe(right["UserID"]) & left["MealID"].eqNullSafe(right["MealID"])


def repeat_ratings(ratings: DataFrame) -> DataFrame:
    """Every rating of a pair but its oldest, with the day it was given.

    A row number over the pair would sort all rows of a pair in one task. Instead:

    1. count rows per pair, on the two key columns alone, and keep the repeated pairs;
    2. keep the rows of these pairs and write each with an id of its own. The repeated pairs
       come back with a real file size, so Spark broadcasts them only when they are small;
    3. find the id of each pair's oldest row by an aggregate that combines on the map side;
    4. anti-join on the id, which no two rows share.

    No step gathers a pair, and rows equal in every column stay apart.
    """
    pairs = stage(duplicate_pairs(ratings).select(*PAIR), "repeated-pairs")
    rows = stage(
        ratings.join(pairs, _same_pair(ratings, pairs), "left_semi").withColumn(
            "row_id", F.monotonically_increasing_id()
        ),
        "repeated-rows",
    )
    age = F.struct("ReviewTime", *_others(ratings), "row_id")
    oldest = rows.groupBy(*PAIR).agg(F.min(age).alias("oldest")).select(F.col("oldest.row_id"))
    return (
        rows.join(oldest, "row_id", "left_anti")
        .drop("row_id")
        .select("MealID", "Rating", "Review", "ReviewTime", "UserID")
        .withColumn("review_date", review_date("ReviewTime"))
    )


def repeats_of_user(ratings: DataFrame, user: str) -> DataFrame:
    """One user's repeats. The filter comes first: it reaches the scan, and pairs never span users."""
    return repeat_ratings(ratings.filter(F.col("UserID") == F.lit(user)))


def ratings_of_user_meal(ratings: DataFrame, user: str, meal: str) -> DataFrame:
    """All ratings one user gave one meal, with the day of each."""
    wanted = (F.col("UserID") == F.lit(user)) & (F.col("MealID") == F.lit(meal))
    return ratings.filter(wanted).withColumn("review_date", review_date("ReviewTime"))
