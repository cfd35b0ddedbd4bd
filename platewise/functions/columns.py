"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_HASH_RANGE = 1 << 32


def percent(part: Column, whole: Column, digits: int = 3) -> Column:
    return F.round(part / whole * 100, digits)


def review_date(seconds: Column | str) -> Column:
    """Day of an epoch-seconds column in the session time zone, as yyyy-MM-dd."""
    return F.date_format(F.from_unixtime(seconds), "yyyy-MM-dd")


def hash_position(keys: Sequence[str]) -> Column:
    """A number in [0, 2^32) fixed by the values of ``keys``: same row, same place, in every run."""
    text = F.concat_ws("|", *[F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def part_name(position: Column, weights: Mapping[str, float]) -> Column:
    """Name of the part that ``position`` falls into; the parts cover the range without overlap."""
    total = sum(weights.values())
    names = list(weights)
    bound, chosen = 0.0, None
    for name in names[:-1]:
        bound += weights[name]
        below = position < F.lit(round(bound / total * _HASH_RANGE))
        chosen = F.when(below, F.lit(name)) if chosen is None else chosen.when(below, F.lit(name))
    last = F.lit(names[-1])
    return last if chosen is None else chosen.otherwise(last)


def sparse_fields(size: Column, indices: Column, values: Column) -> Column:
    """The stored form of a sparse ML vector: a plain struct that parquet holds like the vector itself."""
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        size.cast("int").alias("size"),
        indices.alias("indices"),
        values.alias("values"),
    )


def vector_fields(vector: str) -> Column:
    """The stored fields of a sparse vector column as a plain struct, without making it dense."""
    return F.unwrap_udt(vector)
