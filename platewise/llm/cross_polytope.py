"""Operator 6: nearest neighbours by cross-polytope hashing.

Members are indexed in ranges of length, each range on its own: a vector is lengthened by one more
coordinate to the greatest length of its range, so that the largest inner product is the nearest
direction, and one very long vector leaves the directions of all others as they are. A table's pseudo-rotation
is three rounds of random signs and a fast Hadamard transform; a vector belongs to the signed axis
nearest to it. A query looks into the axes nearest to it in every table. The candidates of all tables
are scored exactly, in double precision, on the original vectors.

Equal vectors are one member of the index, with their smallest ids. A bucket with many members is
dealt into blocks of bounded size by a hash, and a query that probes the bucket visits every block;
no block is skipped. Every vector is indexed.

A query for which the tables yield fewer than ``k`` ids, though there are more, is scored against all
members, block by block; so a query gets all candidates where there are no more than ``k``.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take
no part, nor do null ids. Repeated rows of one id are listed once. Extra columns are not read. Ties
go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.session import stage

K = 20
TABLES = 8
# Signed axes that a query visits in each table, of the 2 x (next power of two) there are.
PROBES = 32
BLOCK_ROWS = 4096
# Lengths of one range differ by less than this factor.
RANGE = 1.25
SEED = 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows, orthonormal; their number of columns is a power of two."""
    n = x.shape[1]
    step = 1
    while step < n:
        x = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.concatenate((x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]), axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def rotate(x: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    """The table's pseudo-rotation: three times random signs, then the transform."""
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), size))
    padded[:, : x.shape[1]] = x
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], (3, size))
    for row in signs:
        padded = hadamard(padded * row)
    return padded


def directions(x: np.ndarray, longest: np.ndarray, query: bool) -> np.ndarray:
    """Unit vectors whose angle orders like the inner product with a query.

    An indexed vector gets a last coordinate that lengthens it to its row's ``longest``; a query gets 0 there.
    """
    length = np.linalg.norm(x, axis=1)
    if query:
        return np.column_stack((x / length[:, None], np.zeros(len(x))))
    rest = np.sqrt(np.maximum(0.0, 1.0 - (length / longest) ** 2))
    return np.column_stack((x / longest[:, None], rest))


def axes(rotated: np.ndarray, probes: int) -> np.ndarray:
    """For every row its ``probes`` nearest signed axes, nearest first: 2j for +j, 2j + 1 for -j."""
    both = np.stack((rotated, -rotated), axis=2).reshape(len(rotated), -1)
    probes = min(probes, both.shape[1])
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def _matrix(vectors) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, 1))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector) of the rows that take part."""
    rows = vectors.select(F.col(key).cast("bigint").alias("key"), F.col(vector).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("key").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
    rows = rows.where(F.exists("vector", lambda x: x != 0.0))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return rows.where(F.size("vector") == (sizes[0]["size"] if sizes else 0))


def length(vector: Column) -> Column:
    """Length of a vector that has a component other than 0, without overflow of the squares."""
    most = F.array_max(F.transform(vector, lambda x: F.abs(x).cast("double")))
    scaled = F.aggregate(vector, F.lit(0.0), lambda a, x: a + (x.cast("double") / most) * (x.cast("double") / most))
    return most * F.sqrt(scaled)


def _buckets(members: DataFrame, tables: int, probes: int, query: bool, schema: str) -> DataFrame:
    """Every row once for each table and axis it belongs to or probes; ``longest`` is its range's length."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = directions(_matrix(batch["vector"]), batch["longest"].to_numpy(), query)
            for table in range(tables):
                found = axes(rotate(x, table), probes)
                part = batch.loc[batch.index.repeat(found.shape[1])].drop(columns="longest")
                yield part.assign(cell=(table << 20) + found.ravel())

    return members.mapInPandas(run, schema)


def _nearest(k: int):
    """Of one block: every query's k best members by exact scores."""

    def run(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": [], "member": [], "score": []}).astype({"query": "int64", "member": "int64"})
        if not len(queries) or not len(members):
            return empty
        q, x, ids = _matrix(queries["vector"]), _matrix(members["vector"]), members["key"].to_numpy()
        out = []
        for at in range(0, len(q), 256):
            some = q[at : at + 256]
            rough = some @ x.T
            n = min(k + 1, len(x))
            best = np.argpartition(-rough, n - 1, axis=1)[:, :n]
            # the cut keeps everything that rounding could still bring in
            least = np.take_along_axis(rough, best, 1).min(axis=1) - 1e-9 * (1 + np.abs(rough).max(axis=1))
            row, column = np.nonzero(rough >= least[:, None])
            score = (some[row] * x[column]).sum(axis=1)
            out.append(pd.DataFrame({"query": queries["key"].to_numpy()[at + row], "member": ids[column], "score": score}))
        return pd.concat(out)

    return run


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    probes: int = PROBES,
) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of every row for which ``is_query`` holds."""
    rows = stage(usable(vectors, key, vector), "vectors")
    # equal vectors: one member that stands for them, and their k + 1 smallest ids
    ids = rows.select("key", F.xxhash64("vector").alias("h"), "vector").distinct()
    members = ids.groupBy("vector").agg(F.min("key").alias("member"))
    numbered = ids.join(members, "vector").select("key", "member")
    members = stage(members.select(F.col("member").alias("key"), "vector"), "members")
    copies = stage(numbered, "copies")
    kind = rows.schema["vector"].dataType.simpleString()
    sized = members.withColumn("length", length(F.col("vector")))
    longest = sized.agg(F.max("length")).first()[0] or 1.0
    # range 0 ends at the greatest length of all, every further one at the start of the one before
    number = F.floor((F.lit(float(np.log(longest))) - F.log("length")) / float(np.log(RANGE)))
    sized = sized.withColumn("range", F.greatest(number, F.lit(0)).cast("int")).drop("length")
    sized = sized.withColumn("longest", F.lit(longest) * F.pow(F.lit(1 / RANGE), "range"))
    schema = f"key bigint, vector {kind}, range int, cell bigint"
    indexed = stage(_buckets(sized, tables, 1, False, schema), "index")
    queries = stage(rows.where(is_query).dropDuplicates(["key"]), "queries")
    # a query's direction is the same in all ranges
    probed = _buckets(queries.withColumn("longest", F.lit(1.0)), tables, probes, True, f"key bigint, vector {kind}, cell bigint")
    # at most 2 x size axes in each table and range, whatever the number of rows: safe to broadcast
    counts = indexed.groupBy("cell", "range").agg(F.ceil(F.count("*") / F.lit(BLOCK_ROWS)).cast("int").alias("blocks"))
    counts = F.broadcast(stage(counts, "cells"))
    left = probed.join(counts, "cell").select(
        "key", "vector", "cell", "range", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    )
    right = indexed.join(counts, ["cell", "range"]).select(
        "key", "vector", "cell", "range", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block")
    )
    ranked = stage(_top(_scored(left, right, ["cell", "range", "block"], k), copies, k), "ranked")
    # queries whose probes met too little
    others = copies.select("key").distinct().count() - 1
    met = ranked.groupBy("query_id").agg(F.count("*").alias("n")).withColumnRenamed("query_id", "key")
    short = queries.join(met, "key", "left").where(F.coalesce("n", F.lit(0)) < min(k, others)).select("key", "vector")
    short = stage(short, "short")
    if short.isEmpty():
        return ranked
    blocks = -(-members.count() // BLOCK_ROWS)
    left = short.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = members.select("*", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block"))
    exact = _top(_scored(left, right, ["block"], k), copies, k)
    again = short.select(F.col("key").alias("query_id"))
    return ranked.join(again, "query_id", "left_anti").unionByName(exact)


def _scored(left: DataFrame, right: DataFrame, by: list[str], k: int) -> DataFrame:
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(
        _nearest(k), "query bigint, member bigint, score double"
    )


def _top(scored: DataFrame, copies: DataFrame, k: int) -> DataFrame:
    from pyspark.sql import Window

    # the k + 1 best members of a query, the query's own vector perhaps among them
    best = Window.partitionBy("query").orderBy(F.desc("score"), "member")
    rows = stage(scored, "scored").distinct().withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    least = Window.partitionBy("member").orderBy("key")
    few = copies.withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1).select("member", "key")
    full = rows.select("query", "member", "score").join(few, "member").where("key <> query")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    ranked = full.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", F.col("key").alias("vec_id"), "score")
