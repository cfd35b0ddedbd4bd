"""Rating-shaped views over order tables (lineitem, orders, part)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Each order line is one rating of a part by the customer who ordered it."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("UserID"),
        F.col("l_partkey").cast("string").alias("MealID"),
        (1 + F.col("l_quantity").cast("bigint") % 5).cast("double").alias("Rating"),
        F.concat("l_returnflag", "l_linestatus").alias("Review"),
        F.unix_timestamp("l_shipdate").alias("ReviewTime"),
    )


def meals(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/part.parquet").select(
        F.col("p_partkey").cast("int").alias("mealno"),
        F.col("p_partkey").cast("string").alias("mealID"),
        F.col("p_name").alias("meal_name"),
    )
