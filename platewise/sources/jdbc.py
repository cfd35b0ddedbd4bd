"""Scan of a table in an external database."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTable:
    """Where a table lives. User and password are read from the named environment variables."""

    url: str
    table: str
    driver: str = "com.mysql.cj.jdbc.Driver"
    user_variable: str = "MEAL_DB_USER"
    password_variable: str = "MEAL_DB_PASSWORD"
    fetch_size: int = 10_000

    def properties(self) -> dict[str, str]:
        properties = {"driver": self.driver, "fetchsize": str(self.fetch_size)}
        for key, variable in (("user", self.user_variable), ("password", self.password_variable)):
            if variable in os.environ:
                properties[key] = os.environ[variable]
        return properties


def read_jdbc(
    spark: SparkSession,
    source: JdbcTable,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One partition by default; with a numeric ``column`` and its range, ``partitions`` parallel reads.

    The bounds only place the splits: rows outside them are still read, by the outer partitions.
    """
    if column is None:
        return spark.read.jdbc(source.url, source.table, properties=source.properties())
    if lower is None or upper is None or partitions is None:
        raise ValueError("a partitioned read needs column, lower, upper and partitions")
    return spark.read.jdbc(
        source.url,
        source.table,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=source.properties(),
    )
