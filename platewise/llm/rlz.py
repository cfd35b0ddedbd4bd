"""Operator 1: substring dedup by a relative Lempel-Ziv parsing against the whole corpus.

The reference is the corpus itself, cut into blocks (see anchors.py) that are indexed by their anchor's
gram. A factor of a document is a run of words that stands in a reference block with an earlier start:
a smaller id, or the same document further ahead. Factors are taken greedily, as long as the words
go on in the same place of the reference; where a factor ends, the windows across its end are looked
up too, so that no window of ``window`` words with an earlier copy is passed over. Factors of
``window`` words or more are duplicate spans, and their words are removed.

How the lookup runs on Spark: grams that occur once are dropped. Blocks of equal content have their
first one as reference; every later one is a factor at once. Only grams under which several contents
stand need their windows compared one by one, and of each content only the first block. Groups are
combined before every shuffle, and no group of copies is gathered.

Null and empty texts have no words and lose none, as do texts of fewer words than a window. A null id
comes after all others. Rows that share an id are told apart by their texts, and the earlier start
comes first among them, so that repeated rows do not remove each other. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm import anchors
from platewise.llm.rolling import mix, prefixes, spans, word_bounds
from platewise.session import stage

WINDOW = 20
GRAM = 5


def _index(window: int, gram: int):
    """(id, print, place, gram, block) of every block of a document."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        ids, prints = (batch.column(i).to_numpy() for i in (0, 1))
        for at, text in enumerate(batch.column(2)):
            data = b" ".join(text.as_py().split())
            starts, ends = word_bounds(data)
            if len(starts) < window:
                continue
            sums = prefixes(data)
            grams = spans(sums, starts[: len(starts) - gram + 1], ends[gram - 1 :])
            anchor, low, high = anchors.blocks(grams, window - gram + 1)
            block = spans(sums, starts[low], ends[high + window - 1])
            place = anchors.pack(low, high)
            own = np.full(len(low), ids[at]), np.full(len(low), prints[at])
            yield *own, place, grams[anchor].view(np.int64), block.view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from anchors.batches_of(["id", "print", "place", "gram", "block"], (row for b in batches for row in rows(b)))

    return run


def _windows(window: int):
    """(id, print, place, start, w1, w2) of every window of the blocks listed with a text."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        ids, prints = (batch.column(i).to_numpy() for i in (0, 1))
        for at, (places,) in enumerate(anchors.lists(batch, ["place"])):
            data = b" ".join(anchors.plain(batch, at).split())
            starts, ends = word_bounds(data)
            low, high = anchors.unpack(places)
            size = high - low + 1
            first = np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            a, b = starts[first], ends[first + window - 1]
            # the second hash is of the bytes reversed: two functions of one text
            w1, w2 = spans(prefixes(data), a, b), spans(prefixes(data[::-1]), len(data) - b, len(data) - a)
            own = np.full(len(first), ids[at]), np.full(len(first), prints[at])
            yield *own, np.repeat(places, size), first, w1.view(np.int64), mix(w2).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from anchors.batches_of(["id", "print", "place", "start", "w1", "w2"], (row for b in batches for row in rows(b)))

    return run


def matches(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id, print, low, high, ref, ref_low): windows low..high that start earlier at ref_low.. of ref."""
    source = docs.mapInArrow(_index(window, gram), "id bigint, print bigint, place bigint, gram bigint, block bigint")
    shared = source.groupBy("gram").count().where("count > 1").select("gram")
    blocks = stage(source.join(shared, "gram", "left_semi"), "blocks")
    start = anchors.start_of(F.col("place"))
    first = F.min(F.struct("id", start.alias("start"), "print", "place")).alias("first")
    contents = stage(blocks.groupBy("gram", "block").agg(first, F.count("*").alias("n")), "contents")

    again = contents.where("n > 1").select("gram", "block", "first")
    later = blocks.join(again, ["gram", "block"]).where(
        F.struct("id", start.alias("start")) > F.struct("first.id", "first.start")
    )
    span = F.shiftright("place", anchors.START_BITS).bitwiseAND(F.lit((1 << anchors.SPAN_BITS) - 1))
    whole = later.select(
        "id",
        "print",
        start.alias("low"),
        (start + span).alias("high"),
        F.col("first.id").alias("ref"),
        F.col("first.start").alias("ref_low"),
    )

    several = contents.groupBy("gram").count().where("count > 1").select("gram")
    unlike = contents.join(several, "gram", "left_semi").select("first.id", "first.print", "first.place")
    listed = anchors.texts_with(docs, unlike, ["place"], "inner")
    cut = stage(
        listed.mapInArrow(_windows(window), "id bigint, print bigint, place bigint, start bigint, w1 bigint, w2 bigint"), "windows"
    )
    known = cut.groupBy("w1", "w2").agg(F.min(F.struct("id", "start")).alias("first"), F.count("*").alias("n"))
    single = cut.join(known.where("n > 1"), ["w1", "w2"]).where(F.struct("id", "start") > F.col("first")).select(
        "id",
        "print",
        F.col("start").alias("low"),
        F.col("start").alias("high"),
        F.col("first.id").alias("ref"),
        F.col("first.start").alias("ref_low"),
    )
    return whole.unionByName(single)


def greedy(low: np.ndarray, high: np.ndarray, ref: np.ndarray, ref_low: np.ndarray, window: int) -> list[tuple]:
    """Factors (start, words, ref, ref_start): runs of matched windows that go on in the same place."""
    order = np.argsort(low, kind="stable")
    low, high, ref, ref_low = low[order], high[order], ref[order], ref_low[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != high[:-1] + 1) | (ref[1:] != ref[:-1]) | (ref_low[1:] - ref_low[:-1] != low[1:] - low[:-1])
    begin = np.flatnonzero(new)
    last = np.concatenate((begin[1:] - 1, [len(low) - 1])) if len(begin) else begin
    return list(zip(low[begin].tolist(), (high[last] - low[begin] + window).tolist(), ref[begin].tolist(), ref_low[begin].tolist()))


def _cut(window: int):
    names = ["id", "carried", "n_words", "n_removed", "kept", "factors"]
    factor = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "words", "ref", "ref_start")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept, parsed = [], [], [], []
            for at, found in enumerate(anchors.lists(batch, ["low", "high", "ref", "ref_low"])):
                words = anchors.plain(batch, at).split()
                factors = greedy(*found, window)
                edge = np.zeros(len(words) + 1, np.int64)
                for start, size, *_ in factors:
                    edge[start] += 1
                    edge[start + size] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                total.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if removed[-1] else b" ".join(words))
                parsed.append([dict(zip(("start", "words", "ref", "ref_start"), f)) for f in factors])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()),
                 pa.array(parsed, factor)], names
            )

    return run


def dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, carry: list[str] | None = None
) -> DataFrame:
    """(key, n_words, n_removed, kept, factors): one row per document; kept words joined by one space.

    A factor's ``ref`` is the id of the document it was found in, null for a null id. ``carry`` names
    columns to keep beside the results.
    """
    carry = carry or []
    source = anchors.keyed(docs, key, text, carry)
    kind = source.schema["carried"].dataType.simpleString()
    found = matches(source, window)
    full = anchors.texts_with(source, found, ["low", "high", "ref", "ref_low"], "left")
    schema = (
        f"id bigint, carried {kind}, n_words bigint, n_removed bigint, kept binary, "
        "factors array<struct<start:bigint,words:bigint,ref:bigint,ref_start:bigint>>"
    )
    out = full.mapInArrow(_cut(window), schema)
    named = F.transform(
        "factors", lambda f: f.withField("ref", F.when(f["ref"] < anchors.NO_ID, f["ref"]))
    ).alias("factors")
    return out.select(
        anchors.unkeyed(key), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"), named,
        *(F.col(f"carried.{c}").alias(c) for c in carry),
    )
