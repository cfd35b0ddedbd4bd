"""Operator 13: exact top-k search with statistics of segments at several resolutions.

Every component x of a vector counts as floor(256 * x). A vector is cut into segments, and every segment
is kept as its mean and its deviation. For two vectors the segments bound their distance from below,
d^2 >= sum of m * ((mean - mean')^2 + (dev - dev')^2) over segments of m components, which is the same as
bounding their inner product from above by the sum of m * (mean * mean' + dev * dev'). The bounds are taken
coarse to fine (``LEVELS``), and only pairs that may still reach a query's k-th best are scored.

The vectors are range-sorted by their coarse means into at most ``MOST_CELLS`` cells, and a cell into
blocks of at most ``BLOCK_ROWS`` rows. A cell is described by the least and greatest of its vectors'
statistics; this table, whose size does not depend on the data, tells a query which cells it may skip:

1. every query is scored in its most promising cell, whose k-th best score is its first threshold;
2. every query visits all other cells whose bound reaches that threshold.

Queries meet a block in groups of bounded size. No cell, block or pair is left out for any reason but its
bound, so the result is exact; a bound is compared with a margin for rounding.

Vectors that are null or hold null or non-finite components take no part, nor do null ids. Vectors are
compared with those of their own length. Of several rows under one id, the smallest vector in array order counts;
repeated rows so count once. Ties go to the smaller id. A table of up to k + 1 vectors gives every query
all others. Scores are exact; one beyond 64 bits is held at the end of their range. Zero vectors
take part. Extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.session import stage

K = 5
# Segments at each resolution, coarse to fine.
LEVELS = (1, 4, 16)
CELL_SEGMENTS = 4
BLOCK_ROWS = 2048
MOST_CELLS = 4096
# Queries that meet a block at one time.
QUERY_ROWS = 1024
_AT_ONCE = 64
_EXACT = float(1 << 53)
_LONGEST = (1 << 63) - 1


def floors(vectors: pd.Series) -> np.ndarray:
    """floor(256 * x) of vectors of one length, as doubles."""
    size = len(vectors.iloc[0]) if len(vectors) else 0
    if not size:
        return np.zeros((len(vectors), 0))
    return np.floor(256.0 * np.stack(vectors.to_numpy()).astype(np.float64))


def _whole(vectors: pd.Series) -> np.ndarray:
    """The same as whole numbers of any size."""
    rows = [[int(x) * 256 if abs(x) >= _EXACT else math.floor(256.0 * x) for x in map(float, v)] for v in vectors]
    out = np.empty((len(rows), len(rows[0]) if rows else 0), dtype=object)
    for i, row in enumerate(rows):
        out[i, :] = row
    return out


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means, then deviations, of the segments of every row, each times the root of the segment's length.

    The product of two such rows is an upper bound of the inner product of the vectors.
    """
    size = x.shape[1]
    segments = min(segments, size)
    if not segments:
        return np.zeros((len(x), 0))
    starts = np.arange(segments) * size // segments
    counts = np.diff(np.concatenate((starts, [size])))
    mean = np.add.reduceat(x, starts, axis=1) / counts
    centred = x - np.repeat(mean, counts, axis=1)
    dev = np.sqrt(np.add.reduceat(centred * centred, starts, axis=1) / counts)
    root = np.sqrt(counts)
    return np.concatenate((mean * root, dev * root), axis=1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector): one row for every id that takes part."""
    rows = vectors.select(F.col(key).cast("bigint").alias("key"), F.col(vector).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("key").isNotNull() & F.col("vector").isNotNull() & finite)
    return rows.groupBy("key").agg(F.min("vector").alias("vector"))


def _described(rows: DataFrame) -> DataFrame:
    """Every row with its length, the statistics of its coarse segments and its strongest segment."""
    kind = rows.schema["vector"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for size, part in batch.groupby(batch["vector"].map(len)):
                with np.errstate(all="ignore"):
                    found = statistics(floors(part["vector"]), CELL_SEGMENTS)
                found = np.nan_to_num(found, nan=np.inf)
                half = found.shape[1] // 2
                wide = np.zeros((len(part), 2 * CELL_SEGMENTS))
                wide[:, :half] = found[:, :half]
                wide[:, CELL_SEGMENTS : CELL_SEGMENTS + half] = found[:, half:]
                strongest = np.abs(wide[:, :CELL_SEGMENTS]).argmax(axis=1)
                yield part.assign(
                    size=size,
                    stats=list(wide),
                    segment=strongest,
                    strength=wide[np.arange(len(part)), strongest],
                )

    return rows.mapInPandas(
        run, f"key bigint, vector {kind}, size int, stats array<double>, segment int, strength double"
    )


def _cells(described: DataFrame) -> DataFrame:
    """Rows sorted into cells by length and strongest segment, and into blocks by their place in the cell."""
    described = stage(described, "described")
    count = max(1, min(MOST_CELLS, -(-described.count() // BLOCK_ROWS)))
    order = ["size", "segment", "strength", "key"]
    placed = described.repartitionByRange(count, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    position = place.bitwiseAND(F.lit((1 << 33) - 1))
    return stage(
        placed.select(
            "key",
            "vector",
            "size",
            "stats",
            F.shiftright(place, 33).cast("int").alias("cell"),
            F.floor(position / BLOCK_ROWS).cast("int").alias("block"),
        ),
        "cells",
    )


def _envelopes(members: DataFrame) -> pd.DataFrame:
    """Of every cell the range of lengths, the ranges of its means, its greatest deviations, and its blocks."""
    many = [F.min("size").alias("shortest"), F.max("size").alias("longest"), F.max("block").alias("last")]
    for i in range(2 * CELL_SEGMENTS):
        at = F.col("stats")[i]
        many += [F.min(at).alias(f"low{i}"), F.max(at).alias(f"high{i}")]
    return members.groupBy("cell").agg(*many).orderBy("cell").toPandas()


def _bounds(stats: np.ndarray, sizes: np.ndarray, cells: pd.DataFrame) -> np.ndarray:
    """Upper bound of every query's scores in every cell; -inf where no vector has the query's length."""
    low = cells[[f"low{i}" for i in range(2 * CELL_SEGMENTS)]].to_numpy()
    high = cells[[f"high{i}" for i in range(2 * CELL_SEGMENTS)]].to_numpy()
    total = np.zeros((len(stats), len(cells)))
    with np.errstate(all="ignore"):
        for i in range(CELL_SEGMENTS):
            mean = stats[:, i : i + 1]
            total += np.maximum(mean * low[:, i], mean * high[:, i])
            j = CELL_SEGMENTS + i
            total += stats[:, j : j + 1] * high[:, j]
    total = np.nan_to_num(total, nan=np.inf)
    total += 1e-9 * np.abs(total) + 1e-6 * (1 + np.linalg.norm(stats, axis=1))[:, None]
    fits = (sizes[:, None] >= cells["shortest"].to_numpy()) & (sizes[:, None] <= cells["longest"].to_numpy())
    return np.where(fits, total, -np.inf)


def _visits(queries: DataFrame, cells: pd.DataFrame, first: bool) -> DataFrame:
    """Every query once for each cell it visits: the most promising one first, then all that may reach ``least``."""
    kind = queries.schema["vector"].dataType.simpleString()
    numbers = cells["cell"].to_numpy()

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            bound = _bounds(np.stack(batch["stats"].to_numpy()), batch["size"].to_numpy(), cells)
            best = bound.argmax(axis=1)
            if first:
                yield batch.assign(least=-np.inf, cell=numbers[best]).drop(columns="stats")
                continue
            reach = ~(bound < batch["least"].to_numpy()[:, None]) & (bound > -np.inf)
            reach[np.arange(len(batch)), best] = False
            row, column = np.nonzero(reach)
            yield batch.iloc[row].assign(cell=numbers[column]).drop(columns="stats")

    return queries.mapInPandas(run, f"key bigint, vector {kind}, size int, least double, cell int")


def _scores(left: np.ndarray, right: np.ndarray, row: np.ndarray, column: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of the pairs; of all rows and columns at one time where most pairs are wanted."""
    if not exact:
        return np.array([min(max(int((left[i] * right[j]).sum()), -_LONGEST - 1), _LONGEST) for i, j in zip(row, column)], np.int64)
    if 8 * len(row) > len(left) * len(right):
        return (left @ right.T)[row, column].astype(np.int64)
    return (left[row] * right[column]).sum(axis=1).astype(np.int64)


def _best(k: int):
    """Of one block: the k best members of every query among those that may reach its threshold."""

    def run(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(members):
            return pd.DataFrame({"query": [], "member": [], "score": []}).astype("int64")
        with np.errstate(all="ignore"):
            return block(queries, members)

    def block(queries, members):
        q, v = floors(queries["vector"]), floors(members["vector"])
        own, ids = queries["key"].to_numpy(), members["key"].to_numpy()
        least = queries["least"].to_numpy().astype(np.float64).copy()
        greatest = np.abs(q).max(initial=0.0) * np.abs(v).max(initial=0.0) * max(1, q.shape[1])
        exact = bool(greatest < _EXACT)
        left, right = (q, v) if exact else (_whole(queries["vector"]), _whole(members["vector"]))
        fine = [(statistics(q, n), statistics(v, n)) for n in LEVELS if n <= max(1, q.shape[1])]
        margin = 1e-9 * np.linalg.norm(q, axis=1) * np.linalg.norm(v, axis=1).max() + 1e-3
        out = []
        for at in range(0, len(q), _AT_ONCE):
            part = slice(at, at + _AT_ONCE)
            others = own[part, None] != ids[None, :]
            bar = least[part] - margin[part]
            bound = fine[0][0][part] @ fine[0][1].T
            unknown = np.flatnonzero(np.isneginf(bar))
            if len(unknown):
                # a first threshold from the members with the best bounds at the finest resolution
                guess = np.nan_to_num(fine[-1][0][part][unknown] @ fine[-1][1].T, nan=np.inf)
                guess = np.where(others[unknown], guess, -np.inf)
                n = min(8 * k, len(ids))
                top = np.argpartition(-guess, n - 1, axis=1)[:, :n]
                met = np.take_along_axis(others[unknown], top, 1)
                row, column = np.nonzero(met)[0], top[met]
                score = np.full(met.shape, -np.inf)
                score[met] = _scores(left[part][unknown], right, row, column, exact)
                if n >= k:
                    bar[unknown] = -np.sort(-score, axis=1)[:, k - 1] - margin[part][unknown]
            row, column = np.nonzero(others & ~(bound < bar[:, None]))
            for ours, theirs in fine[1:]:
                some = ours[part]
                if 8 * len(row) > len(some) * len(theirs):
                    bound = (some @ theirs.T)[row, column]
                else:
                    bound = (some[row] * theirs[column]).sum(axis=1)
                stay = ~(bound < bar[row])
                row, column = row[stay], column[stay]
            score = _scores(left[part], right, row, column, exact)
            stay = score >= bar[row]
            row, column, score = row[stay], column[stay], score[stay]
            order = np.lexsort((ids[column], ~score, row))
            row, column, score = row[order], column[order], score[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            stay = rank < k
            out.append(pd.DataFrame({"query": own[part][row[stay]], "member": ids[column[stay]], "score": score[stay]}))
        return pd.concat(out)

    return run


def _met(visits: DataFrame, members: DataFrame, k: int, label: str) -> DataFrame:
    """(query, member, score): the best members of all blocks that queries visit."""
    visits = stage(visits, f"{label}-visits")
    # one row for every cell, at most MOST_CELLS
    groups = visits.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(QUERY_ROWS)).cast("int").alias("groups"))
    blocks = members.groupBy("cell").agg((F.max("block") + 1).alias("blocks"))
    sizes = F.broadcast(stage(groups.join(blocks, "cell"), f"{label}-groups"))
    left = visits.join(sizes, "cell").select(
        "key",
        "vector",
        "size",
        "least",
        "cell",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("key"), F.col("groups")).cast("int").alias("group"),
    )
    right = members.join(sizes, "cell").select(
        "key", "vector", "size", "cell", "block", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group")
    )
    by = ["cell", "block", "size", "group"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by))
    return stage(found.applyInPandas(_best(k), "query bigint, member bigint, score bigint"), f"{label}-best")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "member")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    vectors: DataFrame, is_query: Column, k: int = K, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every row for which ``is_query`` (over ``key``) holds."""
    members = _cells(_described(usable(vectors, key, vector)))
    cells = _envelopes(members)
    queries = stage(members.where(is_query).select("key", "vector", "size", "stats"), "queries")
    first = _met(_visits(queries, cells, True), members, k, "first")
    least = _ranked(first, k).where(F.col("rank") == k).select(
        F.col("query").alias("key"), F.col("score").cast("double").alias("least")
    )
    unknown = F.coalesce("least", F.lit(float("-inf"))).alias("least")
    known = queries.join(least, "key", "left").select("key", "vector", "size", "stats", unknown)
    second = _met(_visits(known, cells, False), members, k, "second")
    return _ranked(first.unionByName(second), k).select(
        F.col("query").alias("query_id"), "rank", F.col("member").alias("vec_id"), "score"
    )
