"""JSON-lines input and report output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from platewise.schemas import CORRUPT, MEAL_LIST, RATING
from platewise.session import stage

def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan JSON lines under a declared schema, so that no inference pass reads the file first.

    Lines that do not parse keep their text in ``_corrupt_record``; nothing is dropped here.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, RATING)


def read_meals(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, MEAL_LIST)


def _placed(df: DataFrame, single_file: bool) -> DataFrame:
    """One output file where the caller wants it: one task then copies the whole report.

    The report is computed on all cores first, into the staging folder, and copied from there.
    """
    return stage(df, "report").coalesce(1) if single_file else df


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", header: bool = False, single_file: bool = False
) -> None:
    _placed(df, single_file).write.mode(mode).option("header", header).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    _placed(df, single_file).write.mode(mode).json(path)
