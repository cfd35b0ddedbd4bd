"""Catalog database and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from platewise.session import counting


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    spark.catalog.setCurrentDatabase(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as a parquet table and return a scan of it."""
    df.write.mode(mode).format("parquet").saveAsTable(name)
    return df.sparkSession.read.table(name)


def save_counted(df: DataFrame, name: str, mode: str = "overwrite", **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``save_table``, and what was written: its ``rows`` and the given sums, from the write itself."""
    watched, seen = counting(df, **counts)
    return save_table(watched, name, mode), seen.get


def bucketed(df: DataFrame, column: str, buckets: int):
    """A writer of ``buckets`` files by a hash of ``column``, each written by one task and sorted.

    What groups or joins by the column then reads the table without a shuffle. One value stays in one
    file: for columns whose rows per value are bounded, as a user's by the number of meals.
    """
    return df.repartition(buckets, column).write.format("parquet").bucketBy(buckets, column).sortBy(column)


def save_bucketed(df: DataFrame, name: str, column: str, buckets: int, mode: str = "overwrite") -> DataFrame:
    bucketed(df, column, buckets).mode(mode).saveAsTable(name)
    return df.sparkSession.read.table(name)
