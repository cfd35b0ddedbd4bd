"""Declared schemas of the two inputs and the names of the catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

RATING = T.StructType(
    [
        T.StructField("UserID", T.StringType()),
        T.StructField("MealID", T.StringType()),
        T.StructField("Rating", T.DoubleType()),
        T.StructField("Review", T.StringType()),
        T.StructField("ReviewTime", T.LongType()),
    ]
)

MEAL_LIST = T.StructType(
    [
        T.StructField("mealno", T.IntegerType(), False),
        T.StructField("mealID", T.StringType()),
        T.StructField("meal_name", T.StringType()),
    ]
)

# Table names that users' existing queries refer to.
DATABASE = "meals"
MEAL_RATING = "MealRating"
MEAL_LIST_TABLE = "MealList"
CLEANED = "cleaned_mealrating"
MATRIX = "Matrix"
USER_MEAL_IDS = "UserIDANDMealID"
LDA_LIST = "LDARecommendList"
ALS_LIST = "ALSRecommendList"

# Ids of users and meals, for later loads.
USER_IDS = "UserIds"
MEAL_IDS = "MealIds"

# Lines of the inputs that did not parse.
BAD_RATINGS = "BrokenRatings"
BAD_MEALS = "BrokenMeals"


def require(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail early when ``df`` lacks a declared column or holds it under another type.

    Names compare case-insensitively, as column resolution does.
    """
    actual = {field.name.lower(): field.dataType for field in df.schema.fields}
    problems = []
    for field in schema.fields:
        found = actual.get(field.name.lower())
        if found is None:
            problems.append(f"{field.name} is missing")
        elif found != field.dataType:
            problems.append(f"{field.name} is {found.simpleString()}, not {field.dataType.simpleString()}")
    if problems:
        raise ValueError("input does not have the declared schema: " + "; ".join(problems))
    return df
