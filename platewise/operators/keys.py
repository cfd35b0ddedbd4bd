"""Integer ids for text keys, and the way back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platewise.session import stage

# monotonically_increasing_id holds the partition above this bit and the row's position below it.
_POSITION_BITS = 33
_LARGEST_INT = (1 << 31) - 1


def dense_index(df: DataFrame, key: str, index: str) -> DataFrame:
    """(key, index): distinct non-null keys numbered 0..n-1 in key order, the same in every run.

    The keys are range-partitioned and sorted, and staged with their partition and position, so
    that both are fixed. The id is the position plus the number of keys in the partitions before;
    only that one row per partition is summed up and broadcast. The result is staged too: Spark
    would guess the size of a join far too high, and shuffle the ratings to meet a small index.
    """
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    placed = stage(
        keys.repartitionByRange(key)
        .sortWithinPartitions(key)
        .withColumn("place", F.monotonically_increasing_id()),
        f"{key}-places",
    )
    placed = placed.select(
        key,
        F.shiftright("place", _POSITION_BITS).alias("part"),
        F.col("place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("position"),
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("part")
        .agg(F.count("*").alias("keys"))
        .select("part", F.coalesce(F.sum("keys").over(before), F.lit(0)).alias("offset"))
    )
    numbered = placed.join(F.broadcast(offsets), "part").select(
        key, (F.col("offset") + F.col("position")).alias(index)
    )
    return stage(numbered, f"{key}-index")


def extend_index(known: DataFrame, df: DataFrame, key: str, index: str) -> DataFrame:
    """(key, index) of the keys of ``df`` that ``known`` lacks, numbered on behind its largest id.

    ``known`` is an earlier (key, index), as ``dense_index`` and this function make them. Appended to it,
    the result keeps all earlier ids and stays dense, however often and with whatever keys it is extended.
    The new keys are found by an anti-join of the distinct keys; only the largest id visits the plan as a number.
    """
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    fresh = dense_index(keys.join(known.select(key), key, "left_anti"), key, index)
    behind = known.agg(F.coalesce(F.max(index) + 1, F.lit(0))).scalar()
    return fresh.select(key, (F.col(index) + behind).alias(index))


def encode(latest: DataFrame, user_index: DataFrame, meal_index: DataFrame, meals: DataFrame) -> DataFrame:
    """Attach both ids and the meal's attributes; ratings of unlisted meals drop out.

    The two meal-sized tables are joined first, so the ratings meet two joins, not three. The
    result is staged: its size then decides about a broadcast, and where there is none, a side
    that comes straight from a shuffle is what adaptive execution needs to split a hot meal.
    """
    described = stage(meal_index.join(meals, "MealID"), "described-meals")
    names = [name for name in meals.columns if name.lower() != "mealid"]
    return (
        latest.join(user_index, "UserID")
        .join(described, "MealID")
        .select(
            "MealID",
            "UserID",
            *[name for name in latest.columns if name.lower() not in ("mealid", "userid")],
            "UserIndex",
            "MealIndex",
            *names,
        )
    )


def lookup(cleaned: DataFrame, *columns: str) -> DataFrame:
    """Distinct key tuples of the cleaned ratings, for decoding."""
    return cleaned.select(*columns).distinct()


def as_int_id(column: str):
    """The id as an int, or an error that names the column when it does not fit."""
    value = F.col(column)
    return (
        F.when(value.between(0, _LARGEST_INT), value.cast("int"))
        .when(value.isNull(), F.lit(None).cast("int"))
        .otherwise(F.raise_error(F.lit(f"{column} does not fit a 32-bit id")).cast("int"))
        .alias(column)
    )
