"""What the operators share: reading a table's columns, words, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from platewise.session import stage

# Words are runs of anything but the ASCII blanks (space and \x09-\x0D).
BLANKS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table, read by Spark from wherever ``folder`` is."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet").select(*columns)


def words(text: Column) -> Column:
    """Array of the words of a text, unchanged; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def with_value(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside lambda functions."""
    return F.transform(F.array(value), body)[0]


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """(id, root) for every id of ``links`` (a, b): the smallest id of its connected component.

    Alternates the large-star and small-star steps: every round is two aggregations by key, no node
    ever gathers its neighbours in one row, and the number of rounds grows with the logarithm of the
    longest chain. Every round is staged, so a lost executor costs one round.
    """
    edges, known = _noted(_down(links.where("a <> b")), f"{label}-0")
    number = 0
    while True:
        number += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: larger neighbours of u go to u's smallest neighbour
        large = stage(_down(_joined(both, low).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))), f"{label}-l{number}")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # small star: u and its smaller neighbours go to the smallest of them
        near = _joined(large, low)
        small = near.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            low.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        before = known
        edges, known = _noted(_down(small.where("a <> b")), f"{label}-s{number}")
        if before == known:
            break
    # at the fixed point every edge leads straight to the root
    roots = edges.select(F.col("v").alias("id")).distinct().withColumn("root", F.col("id"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)


def _noted(edges: DataFrame, label: str) -> tuple[DataFrame, dict]:
    """The staged edges, and their number and a sum of their hashes, observed while they are written."""
    seen = Observation()
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("total")
    return stage(edges.observe(seen, F.count("*").alias("edges"), total), label), seen.get


def _down(pairs: DataFrame) -> DataFrame:
    """Distinct edges from the larger id u to the smaller id v."""
    return pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def _joined(edges: DataFrame, low: DataFrame) -> DataFrame:
    return edges.join(low, "u")
