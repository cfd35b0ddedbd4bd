"""Bring both inputs into the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from platewise import schemas
from platewise.operators import reports
from platewise.session import stage
from platewise.sources import catalog


def load(
    spark: SparkSession,
    ratings: DataFrame,
    meals: DataFrame,
    database: str = schemas.DATABASE,
    broken: str = "set_aside",
) -> DataFrame:
    """Save the ratings and the meal list as the catalog tables the other jobs read.

    Lines that did not parse are no rows of these tables. ``broken`` says what becomes of them:
    "set_aside" saves them in tables of their own, "fail" raises once both inputs are read and
    leaves the tables as they were. Returns the audit rows (stage, rows).
    """
    if broken not in ("set_aside", "fail"):
        raise ValueError(f"broken is set_aside or fail, not {broken}")
    catalog.use_database(spark, database)
    inputs = (
        (ratings, schemas.RATING, schemas.MEAL_RATING, schemas.BAD_RATINGS),
        (meals, schemas.MEAL_LIST, schemas.MEAL_LIST_TABLE, schemas.BAD_MEALS),
    )
    # read once: Spark can select the lines that did not parse only from what it has already read
    read = [stage(schemas.require(df, schema), table) for df, schema, table, _ in inputs]
    bad = [df.where(f"{schemas.CORRUPT} IS NOT NULL") if schemas.CORRUPT in df.columns else None for df in read]
    if broken == "fail" and any(df is not None and not df.isEmpty() for df in bad):
        raise ValueError("the input has lines that do not parse")
    counts = {}
    for df, lines, (_, schema, table, bad_table) in zip(read, bad, inputs):
        good = df if lines is None else df.where(f"{schemas.CORRUPT} IS NULL")
        counts[table] = catalog.save_counted(good.select(schema.fieldNames()), table)[1]
        if lines is None:
            lines = spark.createDataFrame([], f"{schemas.CORRUPT} string")
        counts[bad_table] = catalog.save_counted(lines.select(schemas.CORRUPT), bad_table)[1]
    return reports.counted_rows(spark, {table: seen["rows"] for table, seen in counts.items()})
