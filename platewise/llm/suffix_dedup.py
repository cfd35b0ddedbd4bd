"""Operator 4: repeated byte strings by distributed prefix doubling.

Two equal strings of ``window`` bytes hold the same anchors at the same offsets (see anchors.py), so
suffixes need to be ranked at anchors only. The phrase of an anchor reaches to the gram of the next
anchor. In round 0 the hash of a phrase is its rank; round r ranks by the hash of a pair of ranks,
that of an anchor and that of the anchor 2^(r-1) further on, which ranks strings of 2^r phrases. A
rank that occurs once is unique, and its position is dropped for good; a position whose string has
come as far as every window through it surely reaches, the threshold, keeps its rank. What is left
are the places whose surroundings stand elsewhere too.

Under a rank, equal blocks of windows are repeated as a whole; where unlike blocks share a rank, at the
ends of repeated passages, their windows are compared one by one, each distinct block once, after a
look at what runs of windows have in common. Every
window that also starts elsewhere is removed, overlaps and the same document included.

Windows are counted in bytes, or in words: then the units are the words' hashes, and all else is alike.

Null and empty texts, and those shorter than a window, lose nothing. Repeated rows are copies of each
other and lose all windows. Extra columns are not read. Kept bytes are bytes: a span may cut through
a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platewise.llm import anchors
from platewise.llm.rolling import mix, prefixes, raw_word_bounds, reversed_word_sums, spans, word_sums
from platewise.session import stage

WINDOW = 400
GRAM = 16
WIDTH = 128  # grams in which an anchor is the smallest; every window holds its first WIDTH grams
WORD_GRAM = 5  # the gram of windows that are counted in words


def widest(window: int, gram: int) -> int:
    """The greatest width of anchors that a window allows."""
    return (window - gram + 2) // 3


def _part(width: int) -> int:
    """Windows that are ruled out together."""
    return max(1, width // 8)


def _sums(data: bytes, by_words: bool) -> np.ndarray:
    return word_sums(data) if by_words else prefixes(data)


def _wordy(data: bytes, window: int, words: int) -> bool:
    """Whether every window of bytes holds ``words`` whole words, so that their runs say all."""
    starts, ends = raw_word_bounds(data)
    begun, ended = np.zeros(len(data) + 1, np.int64), np.zeros(len(data) + 1, np.int64)
    begun[starts + 1], ended[ends] = 1, 1
    begun, ended = np.cumsum(begun), np.cumsum(ended)
    return bool((ended[window:] - begun[: len(begun) - window] >= words).all())


def _index(window: int, gram: int, width: int, by_words: bool, words: int | None):
    """(id, print, number, place, rounds, phrase, block) of every anchor; block is of windows, 0 if it has none."""
    reach = window - 2 * width - gram + 2  # anchors up to here after one belong to all windows through it
    if reach < width:
        raise ValueError("a window must hold three times the anchors' width and a gram")

    def rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        ids, prints = (batch.column(i).to_numpy() for i in (0, 1))
        for at, text in enumerate(batch.column(2)):
            data = text.as_py()
            if len(data) < window or (words and _wordy(data, window, words)):
                continue
            sums = _sums(data, by_words)
            n = len(sums) - 1
            if n < window:
                continue
            every = np.arange(n - gram + 1)
            anchor, low, high = anchors.blocks(spans(sums, every, every + gram), width)
            phrase = spans(sums, anchor[:-1], anchor[1:] + gram)
            # phrases that end within reach
            count = np.searchsorted(anchor, anchor + reach, "right") - 1 - np.arange(len(anchor))
            used = (count > 0)[:-1]
            anchor, low, high, count = (column[:-1][used] for column in (anchor, low, high, count))
            rounds = np.floor(np.log2(count)).astype(np.int64)
            top = np.minimum(high, n - window)
            real = top >= low
            block = np.where(real, spans(sums, low, np.where(real, top + window, low)), 0).view(np.int64)
            place = np.where(real, anchors.pack(low, np.where(real, top, low)), -1)
            own = np.full(len(low), ids[at]), np.full(len(low), prints[at])
            yield *own, np.flatnonzero(used), place, rounds, phrase[used].view(np.int64), block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "print", "number", "place", "rounds", "phrase", "block"]
        yield from anchors.batches_of(names, (row for b in batches for row in rows(b)))

    return run


def double(positions: DataFrame) -> DataFrame:
    """Prefix doubling over (id, print, number, rounds, phrase, ...): the rows left, with their last rank."""
    # the hash of a phrase is its first rank, so the texts are read once and the phrases shuffled once
    times = F.count("*").over(Window.partitionBy("phrase"))
    alive = positions.withColumn("times", times).where("times > 1").drop("times").withColumnRenamed("phrase", "rank")
    alive, done, number = stage(alive, "round-0"), [], 0
    while True:
        number += 1
        # positions that have come as far as they can stay where they were written
        done.append(alive.where(F.col("rounds") == number - 1))
        going = alive.where(F.col("rounds") >= number)
        if going.isEmpty():
            return reduce(DataFrame.unionByName, done)
        other = alive.select("id", "print", (F.col("number") - (1 << (number - 1))).alias("number"), F.col("rank").alias("rank2"))
        # rows of equal ids and texts share all three; any of them stands for the text
        place = ["id", "print", "number"]
        # a pair's hash is its rank: equal strings have equal ranks, and what shares one is compared later on
        pairs = going.join(other.dropDuplicates(place), place).withColumn("rank", F.xxhash64("rank", "rank2")).drop("rank2")
        again = pairs.groupBy("rank").count().where("count > 1").select("rank")
        alive = stage(pairs.join(again, "rank", "left_semi"), f"round-{number}")


def _cores(window: int, gram: int, width: int, by_words: bool):
    """(id, print, place, alone, part, core) of every part of the blocks listed with a text.

    A part has the windows whose anchors lie in the same few offsets; its core is what all windows with
    such an offset hold, also those that a block lacks.
    """

    each = _part(width)

    def rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        ids, prints = (batch.column(i).to_numpy() for i in (0, 1))
        for at, (places, alone) in enumerate(anchors.lists(batch, ["place", "alone"])):
            data = anchors.plain(batch, at)
            sums = _sums(data, by_words)
            low, high = anchors.unpack(places)
            anchor = _anchors(sums, low, gram, width)
            first, last = (anchor - high) // each, (anchor - low) // each
            size = last - first + 1
            part = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            at_anchor = np.repeat(anchor, size)
            core = spans(sums, at_anchor - part * each, at_anchor - part * each - (each - 1) + window)
            yield np.full(len(part), ids[at]), np.full(len(part), prints[at]), np.repeat(places, size), np.repeat(alone, size), part, core.view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from anchors.batches_of(["id", "print", "place", "alone", "part", "core"], (row for b in batches for row in rows(b)))

    return run


def _anchors(sums: np.ndarray, low: np.ndarray, gram: int, width: int) -> np.ndarray:
    """The anchors of the blocks that start at ``low``."""
    reach = low[:, None] + np.arange(width)[None, :]
    return low + np.argmin(spans(sums, reach, reach + gram), axis=1)


def _windows(window: int, gram: int, width: int, by_words: bool):
    """(id, print, place, start, w1, w2) of every window of the parts listed with a text."""
    each = _part(width)

    def rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        ids, prints = (batch.column(i).to_numpy() for i in (0, 1))
        for at, (places, part, alone) in enumerate(anchors.lists(batch, ["place", "part", "alone"])):
            data = anchors.plain(batch, at)
            sums = _sums(data, by_words)
            low, high = anchors.unpack(places)
            anchor = _anchors(sums, low, gram, width)
            low, high = np.maximum(low, anchor - part * each - (each - 1)), np.minimum(high, anchor - part * each)
            size = high - low + 1
            first = np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            w1 = spans(sums, first, first + window)
            # the second hash is of the bytes reversed: two functions of one text
            back, n = reversed_word_sums(data) if by_words else prefixes(data[::-1]), len(sums) - 1
            w2 = mix(spans(back, n - first - window, n - first))
            own = np.full(len(first), ids[at]), np.full(len(first), prints[at])
            yield *own, np.repeat(places, size), np.repeat(alone, size), first, w1.view(np.int64), w2.view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "print", "place", "alone", "start", "w1", "w2"]
        yield from anchors.batches_of(names, (row for b in batches for row in rows(b)))

    return run


def repeats(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    width: int = WIDTH,
    by_words: bool = False,
    words: int | None = None,
) -> DataFrame:
    """(id, print, low, high): runs of windows that also start elsewhere, counted in bytes or words.

    With ``words``, texts of which every window holds so many words are left out.
    """
    schema = "id bigint, print bigint, number bigint, place bigint, rounds bigint, phrase bigint, block bigint"
    left = double(docs.mapInArrow(_index(window, gram, width, by_words, words), schema)).where("place >= 0")
    group = ["rounds", "rank"]
    contents = left.groupBy(*group, "block").agg(F.count("*").alias("n"), F.min(F.struct("id", "print", "place")).alias("one"))
    contents = stage(contents, "contents")
    place = F.col("place")
    low = anchors.start_of(place)
    span = F.shiftright("place", anchors.START_BITS).bitwiseAND(F.lit((1 << anchors.SPAN_BITS) - 1))
    copied = contents.where("n > 1").select(*group, "block")
    whole = left.join(copied, [*group, "block"], "left_semi").select(
        "id", "print", low.alias("low"), (low + span).alias("high")
    )
    several = contents.groupBy(*group).count().where("count > 1").select(*group)
    unlike = contents.join(several, group, "left_semi").select(
        "one.id", "one.print", "one.place", (F.col("n") == 1).cast("bigint").alias("alone")
    )
    listed = anchors.texts_with(docs, unlike, ["place", "alone"], "inner")
    parts = stage(
        listed.mapInArrow(_cores(window, gram, width, by_words), "id bigint, print bigint, place bigint, alone bigint, part bigint, core bigint"),
        "parts",
    )
    # windows whose common core stands nowhere else cannot stand anywhere else
    again = parts.groupBy("core").count().where("count > 1").select("core")
    near = parts.join(again, "core", "left_semi")
    compared = anchors.texts_with(docs, near, ["place", "part", "alone"], "inner")
    schema = "id bigint, print bigint, place bigint, alone bigint, start bigint, w1 bigint, w2 bigint"
    cut = stage(compared.mapInArrow(_windows(window, gram, width, by_words), schema), "windows")
    known = cut.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
    single = cut.where("alone = 1").join(known, ["w1", "w2"], "left_semi").select(
        "id", "print", F.col("start").alias("low"), F.col("start").alias("high")
    )
    return whole.unionByName(single)


def _cut(window: int, words: int | None):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, spans_, kept = [], [], [], []
            for at, (low, high, by_words) in enumerate(anchors.lists(batch, ["low", "high", "by_words"])):
                data = anchors.plain(batch, at)
                start, end = low, high + window
                if by_words.any():
                    starts, ends = raw_word_bounds(data)
                    some = by_words > 0
                    start, end = start.copy(), end.copy()
                    start[some], end[some] = starts[low[some]], ends[high[some] + words - 1]
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, end, -1)
                gone = np.cumsum(edge)[:-1] > 0
                bounds = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).tolist()
                total.append(len(data))
                removed.append(int(gone.sum()))
                spans_.append([{"start": s, "end": e} for s, e in zip(bounds[::2], bounds[1::2])])
                kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes() if removed[-1] else data)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans_, span),
                 pa.array(kept, pa.binary())], ["id", "carried", "n_bytes", "n_removed", "spans", "kept"]
            )

    return run


def dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    carry: list[str] | None = None,
    gram: int = GRAM,
    width: int = WIDTH,
    words: int | None = None,
) -> DataFrame:
    """(key, n_bytes, n_removed, spans, kept): one row per document; spans are the maximal removed runs.

    With ``words``, every run of so many words that also stands elsewhere is removed too, however few its
    bytes and whatever blanks are between; a run of ``window`` bytes that holds so many whole words is
    then cut at words. A shorter window needs a smaller ``width``, see ``widest``.
    ``carry`` names columns to keep beside them.
    """
    carry = carry or []
    source = anchors.keyed(docs, key, text, carry)
    kind = source.schema["carried"].dataType.simpleString()
    found = repeats(source, window, gram, width, words=words).withColumn("by_words", F.lit(0).cast("bigint"))
    if words:
        runs = repeats(source, words, WORD_GRAM, widest(words, WORD_GRAM), by_words=True)
        found = found.unionByName(runs.withColumn("by_words", F.lit(1).cast("bigint")))
    full = anchors.texts_with(source, found, ["low", "high", "by_words"], "left")
    schema = (
        f"id bigint, carried {kind}, n_bytes bigint, n_removed bigint, "
        "spans array<struct<start:bigint,end:bigint>>, kept binary"
    )
    return full.mapInArrow(_cut(window, words), schema).select(
        anchors.unkeyed(key), "n_bytes", "n_removed", "spans", "kept", *(F.col(f"carried.{c}").alias(c) for c in carry)
    )
