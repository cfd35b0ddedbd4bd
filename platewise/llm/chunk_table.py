"""Operator 7: SentencePiece encoding and decoding through a table of distinct marked words.

Where no piece of the vocabulary has a whitespace marker after another character, a piece cannot cross
from one marked word (markers, then the characters up to the next marker) into the next, and the
merges of one marked word never depend on another. So a task takes half a megabyte of texts at a time,
makes a table of their distinct marked words, has the library segment every entry once, and joins the
ids back by position. The table is bounded by the texts it is made from; a longer text has one of its
own. A model without that property, or whose normaliser changes texts, encodes whole texts.

Null and empty texts encode to the end id alone and decode to an empty text. Repeated rows and equal
ids are encoded one by one; texts of any length stay whole; columns other than the id and the text
are not read. Null ids decode to an empty text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKER = "▁"
CHUNK = re.compile(" +[^ ]*")

# Text (or ids) that a task works on at a time.
PART_CHARS = 1 << 19


def load(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


@lru_cache(maxsize=2)
def splits_at_markers(model: bytes) -> bool:
    """Whether marked words can be encoded one by one."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    how = proto.normalizer_spec
    plain = how.add_dummy_prefix and how.escape_whitespaces and not how.remove_extra_whitespaces
    kinds = {kind.name: kind.number for kind in proto.SentencePiece.Type.DESCRIPTOR.values}
    own = [p for p in proto.pieces if p.type in (kinds["NORMAL"], kinds["USER_DEFINED"])]
    inside = not any(MARKER in p.piece.lstrip(MARKER) or p.type == kinds["USER_DEFINED"] for p in own)
    fallback = proto.trainer_spec.byte_fallback  # no unknown pieces, which would merge across words
    return bool(plain and inside and fallback and not how.precompiled_charsmap and not proto.trainer_spec.treat_whitespace_as_suffix)


def by_table(processor: sentencepiece.SentencePieceProcessor, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, where each text's ids end) through one table of distinct marked words."""
    chunks = [CHUNK.findall(" " + text.replace(MARKER, " ")) if text else [] for text in texts]
    placed = pa.array(list(chain.from_iterable(chunks)), pa.large_string()).dictionary_encode()
    # the library puts one marker before whatever it encodes, but none before nothing
    entries = processor.encode([chunk[1:] for chunk in placed.dictionary.to_pylist()])
    marker = [processor.piece_to_id(MARKER)]
    entries = [ids or marker for ids in entries]
    sizes = np.fromiter(map(len, entries), np.int64, len(entries))
    values = np.fromiter(chain.from_iterable(entries), np.int32, int(sizes.sum()))
    return join_back(values, sizes, placed.indices.to_numpy(), np.fromiter(map(len, chunks), np.int64, len(chunks)))


def join_back(values: np.ndarray, sizes: np.ndarray, places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lay the entries at ``places`` end to end; ``counts`` entries belong to each text."""
    first = np.cumsum(sizes) - sizes
    long = sizes[places]
    ends = np.concatenate(([0], np.cumsum(long)))
    steps = np.arange(ends[-1]) - np.repeat(ends[:-1], long) + np.repeat(first[places], long)
    return values[steps], ends[np.cumsum(counts)]


def whole(processor: sentencepiece.SentencePieceProcessor, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The same without a table."""
    ids = processor.encode(texts)
    return np.fromiter(chain.from_iterable(ids), np.int32), np.cumsum([len(x) for x in ids])


def _parts(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of rows of about PART_CHARS together."""
    start = total = 0
    for at, size in enumerate(sizes):
        total += size
        if total >= PART_CHARS:
            yield start, at + 1
            start, total = at + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the ids of every whole text, closed by the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = load(model)
        segment = by_table if splits_at_markers(model) else whole
        for batch in batches:
            for start, end in _parts(pc.binary_length(batch.column(1)).to_pylist()):
                keys = batch.column(0).slice(start, end - start)
                ids, ends = segment(processor, batch.column(1).slice(start, end - start).to_pylist())
                ids = np.insert(ids, ends, processor.eos_id())
                offsets = np.concatenate(([0], ends + np.arange(1, len(ends) + 1))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(offsets, pa.array(ids))], ["key", "ids"])

    source = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, model: bytes, key: str = "doc_id") -> DataFrame:
    """(key, ids, text): what the library makes of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = load(model)
        for batch in batches:
            sizes = [size or 0 for size in pc.list_value_length(batch.column(1)).to_pylist()]
            for start, end in _parts(sizes):
                part = batch.slice(start, end - start)
                flat, at, texts = part.column(1).flatten().to_numpy().tolist(), 0, []
                for size in sizes[start:end]:
                    texts.append(processor.decode(flat[at : at + size]))
                    at += size
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["key", "ids", "text"])

    source = encoded.select(F.col(key).alias("key"), "ids")
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, ids array<int>, text string").withColumnRenamed("key", key)


def model_bytes(path: str | Path) -> bytes:
    """A model file, read once by the driver; tasks get its bytes."""
    return Path(path).read_bytes()
