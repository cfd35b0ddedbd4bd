"""Blocks of windows around anchors, shared by the two substring operators.

All windows of one length are grouped by their anchor: the place of the smallest gram hash in the first
part of the window. The anchor depends on the window's content alone, so equal windows have equal
grams at equal offsets, wherever they stand, and consecutive windows with one anchor form a block.
Blocks are named by rows of longs: the document's id and a 64-bit fingerprint of its text, its place (the
number of windows, the first window's start), a gram or rank, and the hash of the block's content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.rolling import minima

# place = (windows - 1) << 32 | start
START_BITS, SPAN_BITS = 32, 8
NO_ID = (1 << 63) - 1  # stands for a null id, after all others


def keyed(docs: DataFrame, key: str, text: str, carry: list[str]) -> DataFrame:
    """(id, print, text in bytes, carried). Rows that share an id are told apart by the fingerprint."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(body).alias("print"),
        body.cast("binary").alias("text"),
        F.struct(*carry, F.lit(0).alias("_")).alias("carried"),
    )


def unkeyed(name: str) -> Column:
    return F.when(F.col("id") < NO_ID, F.col("id")).alias(name)


def pack(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return ((high - low) << np.int64(START_BITS)) | low


def start_of(place: Column) -> Column:
    return place.bitwiseAND(F.lit((1 << START_BITS) - 1))


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = place & np.int64((1 << START_BITS) - 1)
    return low, low + ((place >> np.int64(START_BITS)) & np.int64((1 << SPAN_BITS) - 1))


def blocks(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window) of every block, in order."""
    if len(grams) < width:
        return (np.zeros(0, np.int64),) * 3
    place = minima(grams, width)
    cut = np.flatnonzero(np.diff(place)) + 1
    low = np.concatenate(([0], cut))
    return place[low], low, np.concatenate((cut - 1, [len(place) - 1]))


def batches_of(names: list[str], rows: Iterator[tuple[np.ndarray, ...]], limit: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of long columns from many small groups of rows."""
    held, size = [], 0
    for group in rows:
        held.append(group)
        size += len(group[0])
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)


def texts_with(docs: DataFrame, rows: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Documents with the rows of theirs as arrays; ``rows`` has id, print and the columns (all long).

    The rows of one document are bounded by its text. The texts are shuffled once, by id, compressed;
    ``plain`` is the way back.
    """
    packed = rows.groupBy("id", "print").agg(F.collect_list(F.struct(*columns)).alias("rows"))
    found = docs.mapInArrow(_compressed, docs.schema).join(packed, ["id", "print"], how)
    return found.select("id", "print", "text", "carried", *(F.col(f"rows.{name}").alias(name) for name in columns))


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = pa.array((compressor.compress(text.as_py()) for text in batch.column(2)), batch.schema.field(2).type)
        yield batch.set_column(2, batch.schema.field(2), texts)


def plain(batch: pa.RecordBatch, row: int) -> bytes:
    """The text of a row of ``texts_with``."""
    return zstandard.decompress(batch.column(2)[row].as_py())


def lists(batch: pa.RecordBatch, names: list[str]) -> Iterator[list[np.ndarray]]:
    """For every row of a batch its array columns as numpy arrays, empty for null."""
    columns = [batch.column(batch.schema.get_field_index(name)) for name in names]
    for i in range(batch.num_rows):
        yield [np.zeros(0, np.int64) if (v := c[i]).as_py() is None else v.values.to_numpy() for c in columns]
