"""Operator 8: mixing sources to target weights along a time-varying curriculum.

Training runs from time 0 to 1. Every source has a schedule: weights at evenly spaced times, linear
between them. The integral of a schedule is the source's weight, and by these weights the sources
share the words wanted; no source gives more than ``most`` times its own words, and what it cannot
give is shared again among the others. The documents of a source follow each other in an order
drawn from a hash of their ids, once or more, until the source's target is met; the last one gives
only its first words. A document's position is the time at which the cumulative demand of its
source's schedule reaches its first word.

Null texts have no words. A null source is a source of its own, after all others. Documents without
words are taken 0 times and sources without words have target 0. Repeated rows are documents of
their own. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.llm.common import words
from platewise.operators.keys import dense_index
from platewise.session import stage

# Relative course of the weights, repeated over the sources: first falling, flat, rising.
SCHEDULES = ((7.5, 5.0, 2.5), (2.0, 2.0, 2.0), (0.5, 1.0, 1.5))

# A source's documents are ordered in so many slices by hash, so that no task orders a whole source.
SLICE_DIGITS = 3


def integral(knots: tuple[float, ...]) -> list[float]:
    """Cumulative weight at every knot."""
    total = [0.0]
    for left, right in zip(knots, knots[1:]):
        total.append(total[-1] + (left + right) / 2 / (len(knots) - 1))
    return total


def _place_sources(sized: DataFrame, classes: int) -> DataFrame:
    """(source, source_size, class): sources by code point, null last, numbered round the schedules."""
    sources = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    named = dense_index(sources.where("source IS NOT NULL"), "source", "place")
    last = sources.where("source IS NOT NULL").count()
    placed = sources.join(named, "source", "left").withColumn("place", F.coalesce("place", F.lit(last)))
    return placed.select("source", "source_size", (F.col("place") % classes).cast("int").alias("class"))


def targets(sources: DataFrame, weights: list[float], wanted: float, most: float) -> DataFrame:
    """Adds ``target``: ``wanted`` words shared by weight, at most ``most`` times a source's words.

    Every round is one aggregate over the sources and hands the driver two numbers. A source over its
    limit is set to it; the rest is shared anew until no source is over. The last round is kept.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("class") + 1)
    sources = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(most))
    level = None
    while True:
        over = F.lit(False) if level is None else F.lit(level) * F.col("weight") > F.col("limit")
        capped, free, n = sources.agg(
            F.coalesce(F.sum(F.when(over, F.col("limit"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(over, 1)),
        ).first()
        if level is not None and n == before:
            break
        before = n
        level = (wanted - capped) / free if free else 0.0
    share = F.when(over, F.col("limit")).otherwise(F.lit(level) * F.col("weight"))
    return sources.withColumn("target", share).drop("weight", "limit")


def time_of(demand: Column, schedules: tuple[tuple[float, ...], ...]) -> Column:
    """The time by which the fraction ``demand`` of a schedule's integral is reached; column ``class``."""
    found = None
    for number, knots in enumerate(schedules):
        sums, parts = integral(knots), len(knots) - 1
        wanted = demand * sums[-1]
        place = F.lit(0.0)
        for j in range(parts):
            rest = wanted - sums[j]
            under = F.sqrt(F.lit(knots[j] * knots[j]) + 2.0 * (knots[j + 1] - knots[j]) * parts * rest)
            step = F.lit(j / parts) + F.lit(2.0) * rest / (F.lit(knots[j]) + under)
            place = step if j == 0 else F.when(wanted >= sums[j], step).otherwise(place)
        found = place if found is None else F.when(F.col("class") == number, place).otherwise(found)
    return F.least(found, F.lit(1.0))


def mix(
    docs: DataFrame,
    share: float = 1.5,
    most: float = 2.0,
    schedules: tuple[tuple[float, ...], ...] = SCHEDULES,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per document: (key, size, source_size, target, taken, passes).

    ``passes`` has a (position, words) for every time the document is used, in order of use: whole
    passes first, then perhaps its first words only. ``taken`` is the sum of its words.
    """
    if any(len(knots) < 2 or min(knots) <= 0 for knots in schedules):
        raise ValueError("a schedule needs two weights or more, all above 0")
    sized = stage(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).alias("source"),
            F.size(words(F.col(text))).cast("bigint").alias("size"),
            F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("draw"),
            F.xxhash64(text).alias("print"),
        ),
        "sized",
    )
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    weights = [integral(knots)[-1] for knots in schedules]
    placed = stage(targets(_place_sources(sized, len(schedules)), weights, share * total, most), "targets")

    sliced = sized.withColumn("slice", F.substring("draw", 1, SLICE_DIGITS))
    sums = sliced.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = stage(sums.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words"), "slices")
    order = Window.partitionBy("source", "slice").orderBy("draw", "key", "print", "size")
    within = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    started = sliced.withColumn("within", within)
    based = started.alias("d").join(
        sums.alias("s"), F.expr("d.source <=> s.source AND d.slice = s.slice"), "left"
    ).select("d.*", (F.col("within") + F.col("base")).alias("start"))
    full = based.alias("d").join(placed.alias("p"), F.expr("d.source <=> p.source")).select(
        "key", "size", "source_size", "target", "start", "class"
    )

    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor(F.col("target") - F.col("whole") * F.col("source_size") + 0.5)
    part = F.greatest(F.lit(0), F.least("size", rest - F.col("start")))
    counted = full.withColumn("whole", whole.cast("bigint")).withColumn("part", part.cast("bigint"))

    def used(number: Column, size: Column) -> Column:
        demand = (number * F.col("source_size") + F.col("start")) / F.col("target")
        return F.struct(time_of(demand, schedules).alias("position"), size.alias("words"))

    entire = F.when(
        (F.col("whole") > 0) & (F.col("size") > 0),
        F.transform(F.sequence(F.lit(0), F.col("whole") - 1), lambda i: used(i, F.col("size"))),
    )
    partial = F.when(F.col("part") > 0, F.array(used(F.col("whole"), F.col("part"))))
    none = F.array().cast("array<struct<position:double,words:bigint>>")
    passes = F.concat(F.coalesce(entire, none), F.coalesce(partial, none))
    taken = (F.col("whole") * F.col("size") + F.col("part")).alias("taken")
    return counted.select(F.col("key").alias(key), "size", "source_size", "target", taken, passes.alias("passes"))


def curriculum(mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, position, words, pass), one row per use, range-sorted by training position."""
    uses = mixed.select(key, F.posexplode("passes").alias("pass", "use"))
    flat = uses.select(key, F.col("use.position").alias("position"), F.col("use.words").alias("words"), "pass")
    return flat.repartitionByRange("position", key).sortWithinPartitions("position", key, "pass")
