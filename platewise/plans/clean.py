"""From raw ratings to the cleaned table and the split files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise import schemas
from platewise.operators import keys, repeats, reports, splits
from platewise.session import counting, stage_by
from platewise.sources import catalog
from platewise.sources.files import write_json


def clean(ratings: DataFrame, meals: DataFrame) -> DataFrame:
    """Latest rating per user and meal, with integer ids and the meal's attributes.

    Every user and meal keeps at least one rating, so the ids are taken from one column each of the
    raw ratings. The latest ratings then have a single reader and are never written on their own.
    """
    users = keys.dense_index(ratings, "UserID", "UserIndex")
    meal_index = keys.dense_index(ratings, "MealID", "MealIndex")
    return keys.encode(repeats.latest_ratings(ratings), users, meal_index, meals)


def indexes(ratings: DataFrame, keep_ids: bool) -> tuple[DataFrame, DataFrame]:
    """(user ids, meal ids) as saved tables; with ``keep_ids`` earlier ids stay and new keys get the next ones."""
    spark, found = ratings.sparkSession, []
    for key, index, table in (("UserID", "UserIndex", schemas.USER_IDS), ("MealID", "MealIndex", schemas.MEAL_IDS)):
        if keep_ids and spark.catalog.tableExists(table):
            fresh = keys.extend_index(catalog.read_table(spark, table), ratings, key, index)
            found.append(catalog.save_table(fresh, table, mode="append"))
        else:
            found.append(catalog.save_table(keys.dense_index(ratings, key, index), table))
    return found[0], found[1]


def run(
    spark: SparkSession,
    split_folder: str | None = None,
    database: str = schemas.DATABASE,
    keep_ids: bool = False,
    exact: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Save the cleaned table, write the split files and return the row counts per stage.

    ``keep_ids`` takes up the ids of the run before: users and meals keep theirs, new ones follow.
    ``exact`` gives the split files exactly their shares of the rows. ``buckets`` saves the cleaned table in
    so many buckets by user. The counts come from the writes.
    """
    catalog.use_database(spark, database)
    ratings = catalog.read_table(spark, schemas.MEAL_RATING)
    meals = catalog.read_table(spark, schemas.MEAL_LIST_TABLE)
    users, meal_index = indexes(ratings, keep_ids)
    result = keys.encode(repeats.latest_ratings(ratings), users, meal_index, meals)
    if buckets:
        cleaned = catalog.save_bucketed(result, schemas.CLEANED, "UserID", buckets)
    else:
        cleaned = catalog.save_table(result, schemas.CLEANED)
    assign = splits.split_exactly if exact else splits.assign_parts
    # the part is named once, and each file then reads its own folder only
    watched, seen = counting(assign(cleaned), **{name: F.count_if(F.col("part") == name) for name in splits.SHARES})
    named = stage_by(watched, "part", "parts")
    if split_folder:
        for name in splits.SHARES:
            write_json(named.where(F.col("part") == name).drop("part"), f"{split_folder}/{name}data.json")
    parts = dict(seen.get)
    counts = reports.counted_rows(spark, {"cleaned": parts.pop("rows")} | parts)
    return reports.row_counts({"ratings": ratings}).unionByName(counts)
