"""Operator 11: groups of spelling variants by an index of variable-length grams.

Words are the runs of letters of the texts, A-Z lower-cased, that have at least ``LEAST_LENGTH`` code points and
``LEAST_COUNT`` occurrences. Two are near if one inserted, deleted or replaced code point makes them equal.

The words stand between two marks. The dictionary holds all grams of two code points, and of the longer ones
those whose gram without the last code point is frequent and that are not rare themselves; so a frequent gram
is told apart by what follows, and its list is short. At every place a word has the longest gram of the
dictionary that fits there, unless a gram that began earlier reaches as far.

One edit leaves the grams before and behind it as they are, but for those

* that hold the edited place;
* that end right before it and that the dictionary can lengthen;
* behind it, whose text from the edit on is the end of a longer gram, which may now swallow them.

The most grams that an edit at any place can affect is the word's bound N. Near words so share all but N
of the grams of either. Taken rarest first, at least one common gram is among the first N + 1 of both:
only these N + 1 lists are read for a word. They are kept by place too, which an edit shifts by one at most.

Words are compared in classes of the lengths n and n + 1. In class n grams have at most (n + 1) / 2 code points:
then no edit can affect all grams of a word, so N + 1 lists always suffice and no pair is missed. What shares a list
is verified by its edit distance.

The dictionary's size is bounded (``MOST_FREQUENT`` frequent grams of every length, a parameter that changes
the lists' lengths and no result), so tasks can hold it. Lists are joined by Spark, which splits long ones. Forms
are followed by doubling: the root of the root of a word, until nothing changes.

Null and empty texts have no words. A null id is written as an empty text before the colon. Runs of any
length are words, and repeated rows count as often as they stand there. An empty table gives no rows. Columns
other than the id and the text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.rolling import mix
from platewise.session import stage

LEAST_LENGTH = 5
LEAST_COUNT = 3
# Of the runs of every document one in so many loses a code point.
EVERY = 97
# A form occurs so many times as often as its word.
FORM_FACTOR = 2

SHORTEST, LONGEST = 2, 8
# Grams of one length that can be frequent: at most so many have over 1 / MOST_FREQUENT of all places.
MOST_FREQUENT = 1 << 14
# A gram is rare below this share of what makes it frequent.
RARE = 1 / 16
LEAST_FREQUENT = 64

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_RUN = re.compile("[a-zÀ-ÿ]+")
# Code points as 7-bit numbers: a-z, then À-ÿ, then the marks.
_START, _END = 91, 92
_BITS = 7
_HELD = 1 << 18


# ---------------------------------------------------------------- words


def altered(prefix: int, run: str, data: bytes) -> str:
    """The run, without one code point if the checksum that starts with ``prefix`` says so."""
    h = zlib.crc32(data, prefix)
    if h % EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def counted_words(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            texts = batch.column(1)
            for place, name in enumerate(batch.column(0).to_pylist()):
                body = texts[place].as_buffer().to_pybytes().translate(_LOWER).decode()
                prefix = zlib.crc32(f"{name}:".encode())
                for word, n in Counter(_RUN.findall(body)).items():
                    word = altered(prefix, word, word.encode())
                    if len(word) >= LEAST_LENGTH:
                        counts[word] += n
                if len(counts) >= _HELD:
                    yield flush()
                    counts.clear()
        yield flush()

    name = F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key")
    source = docs.where(F.length(text) >= LEAST_LENGTH).select(name, F.col(text).cast("binary").alias("text"))
    counted = source.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# ---------------------------------------------------------------- grams


def numbers_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all marked words, where each word starts and the last one ends)."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(starts[-1], np.int64)
    points = np.frombuffer("".join(words).encode("latin-1"), np.uint8).astype(np.int64)
    points = np.where(points < 128, points - 96, points - 192 + 27)
    inner = np.ones(len(out), bool)
    inner[starts[:-1]] = inner[starts[1:] - 1] = False
    out[inner] = points
    out[starts[:-1]], out[starts[1:] - 1] = _START, _END
    return out, starts


def grams(points: np.ndarray, size: int) -> np.ndarray:
    """The gram of ``size`` code points at every place where the array has so many more."""
    n = max(0, len(points) - size + 1)
    out = np.zeros(n, np.int64)
    for i in range(size):
        out = (out << _BITS) | points[i : i + n]
    return out


def _gram_counts(words: DataFrame) -> DataFrame:
    """(size, gram, n) over all marked words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, starts = numbers_of(batch.column(0).to_pylist())
            left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(points))
            for size in range(SHORTEST, LONGEST + 1):
                found, n = np.unique(grams(points, size)[left[: max(0, len(points) - size + 1)] >= size], return_counts=True)
                sizes = np.full(len(found), size, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(sizes), pa.array(found), pa.array(n)], ["size", "gram", "n"])

    found = words.select("word").mapInArrow(run, "size int, gram bigint, n bigint")
    return found.groupBy("size", "gram").agg(F.sum("n").alias("n"))


class Dictionary:
    """The grams of the dictionary by length, sorted, with how often they occur."""

    def __init__(self, sizes: np.ndarray, found: np.ndarray, counts: np.ndarray):
        self.grams, self.counts = {}, {}
        for size in range(SHORTEST, LONGEST + 1):
            some = sizes == size
            order = np.argsort(found[some])
            self.grams[size], self.counts[size] = found[some][order], counts[some][order]
        self._made: dict = {}

    def __reduce__(self):
        sizes = np.repeat(list(self.grams), [len(g) for g in self.grams.values()])
        return Dictionary, (sizes, np.concatenate(list(self.grams.values())), np.concatenate(list(self.counts.values())))

    def _once(self, key, make):
        if key not in self._made:
            self._made[key] = make()
        return self._made[key]

    def longer(self, size: int) -> np.ndarray:
        """Grams of ``size`` code points that the dictionary can lengthen by one."""
        return self._once(("longer", size), lambda: np.unique(self.grams.get(size + 1, np.zeros(0, np.int64)) >> _BITS))

    def ends(self, size: int, longest: int) -> np.ndarray:
        """Ends of ``size`` code points that longer grams of at most ``longest`` have."""
        mask = np.int64((1 << (_BITS * size)) - 1)
        every = [self.grams[n] & mask for n in range(size + 1, longest + 1)]
        return self._once(("ends", size, longest), lambda: np.unique(np.concatenate([np.zeros(0, np.int64), *every])))


def dictionary(words: DataFrame, most_frequent: int = MOST_FREQUENT) -> Dictionary:
    """Grams of two code points, and longer ones that follow a frequent gram and are not rare."""
    counts = stage(_gram_counts(words), "grams")
    places = counts.where(F.col("size") == SHORTEST).agg(F.sum("n")).first()[0] or 0
    frequent = max(LEAST_FREQUENT, places // most_frequent)
    before = counts.where(F.col("n") > frequent).select((F.col("size") + 1).alias("size"), F.col("gram").alias("before"))
    after = counts.where(F.col("n") >= max(2, int(frequent * RARE))).withColumn("before", F.shiftright("gram", _BITS))
    longer = after.join(before, ["size", "before"]).select("size", "gram", "n")
    # grams of two: at most 92^2; longer ones: at most most_frequent / RARE of each length
    rows = longer.unionByName(counts.where(F.col("size") == SHORTEST)).toArrow()
    return Dictionary(*(rows.column(name).to_numpy() for name in ("size", "gram", "n")))


def _among(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def first_lists(points: np.ndarray, starts: np.ndarray, known: Dictionary, longest: int):
    """(word, gram, place) of the rarest N + 1 grams of every word, with grams of at most ``longest``.

    ``place`` counts from the start of the marked word.
    """
    total = len(points)
    word = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    left = starts[word + 1] - np.arange(total)
    at_size = {size: np.concatenate((grams(points, size), np.zeros(total, np.int64)))[:total] for size in range(SHORTEST, longest + 1)}
    # the longest gram at every place; where a word has no place for two, none
    size = np.where(left >= SHORTEST, SHORTEST, 0)
    gram = at_size[SHORTEST].copy()
    for n in range(SHORTEST + 1, longest + 1):
        open_ = np.flatnonzero((size == n - 1) & (left >= n))
        here = open_[_among(known.grams[n], at_size[n][open_])]
        size[here], gram[here] = n, at_size[n][here]
    last = np.arange(total) + size - 1
    reach = np.maximum.accumulate(last)
    kept = np.flatnonzero((size > 0) & (last > np.concatenate(([-1], reach[:-1]))))
    size, gram, last = size[kept], gram[kept], last[kept]

    # grams affected by an edit of the place, and by an insertion before it
    edit, gap = np.zeros(total + 2, np.int64), np.zeros(total + 2, np.int64)

    def add(to, low, high):
        np.add.at(to, low, 1)
        np.add.at(to, high + 1, -1)

    add(edit, kept, last)
    add(gap, kept + 1, last)
    for n in range(SHORTEST, longest):
        some = np.flatnonzero(size == n)
        grows = some[_among(known.longer(n), gram[some])]
        for to in (edit, gap):
            add(to, last[grows] + 1, last[grows] + 1)
        # behind the edit: text of n code points that ends with the gram
        first = last - n + 1
        some = np.flatnonzero((first <= kept) & (first > starts[word[kept]]))
        inside = some[_among(known.ends(n, longest), at_size[n][first[some]])]
        add(edit, first[inside] - 1, first[inside] - 1)
        add(gap, first[inside], first[inside])
    edit, gap = np.cumsum(edit)[:total], np.cumsum(gap)[:total]
    inner = (np.arange(total) > starts[word]) & (left > 1)
    worst = np.maximum(np.where(inner, edit, 0), np.where(np.arange(total) > starts[word], gap, 0))
    bound = np.maximum.reduceat(worst, starts[:-1])

    counts = np.zeros(len(kept), np.int64)
    for n in range(SHORTEST, longest + 1):
        some = np.flatnonzero(size == n)
        if len(some) and len(known.grams[n]):
            at = np.minimum(np.searchsorted(known.grams[n], gram[some]), len(known.grams[n]) - 1)
            counts[some] = known.counts[n][at]
    order = np.lexsort((kept, gram, counts, word[kept]))
    owner = word[kept][order]
    rank = np.arange(len(order)) - np.searchsorted(owner, owner)
    order = order[rank <= bound[owner]]
    # the gram with its length, as grams of different lengths can be equal numbers only behind leading marks
    return word[kept[order]], gram[order] | (size[order] << np.int64(56)), kept[order] - starts[word[kept[order]]]


def longest_gram(length: int) -> int:
    """Code points of the grams in the class of words of ``length`` and one more."""
    return min(LONGEST, (length + 1) // 2)


def _lists(words: DataFrame, known: Dictionary) -> DataFrame:
    """(list, longer, word, n): every word in the lists it is read from and kept in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            lengths = np.fromiter(map(len, names), np.int64, len(names))
            # a word is the shorter one in the class of its length, and the longer one in the class before
            for longer in (False, True):
                classes = lengths - longer
                tops = np.minimum(LONGEST, (classes + 1) // 2)
                for top in np.unique(tops[classes >= LEAST_LENGTH]).tolist():
                    some = np.flatnonzero((tops == top) & (classes >= LEAST_LENGTH))
                    points, starts = numbers_of([names[i] for i in some])
                    owner, gram, place = first_lists(points, starts, known, top)
                    owner = some[owner]
                    if longer:
                        # before the edit a gram stands at the shorter word's place, behind it one further
                        owner, gram, place = np.tile(owner, 2), np.tile(gram, 2), np.concatenate((place, place - 1))
                    list_ = mix(mix(gram.view(np.uint64)) + ((classes[owner] << 32) + place + 1).view(np.uint64))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(list_.view(np.int64)),
                            pa.array(np.full(len(owner), longer)),
                            batch.column(0).take(pa.array(owner)),
                            batch.column(1).take(pa.array(owner)),
                        ],
                        ["list", "longer", "word", "n"],
                    )

    return words.select("word", "n").mapInArrow(run, "list bigint, longer boolean, word string, n bigint")


def near_pairs(words: DataFrame, known: Dictionary) -> DataFrame:
    """(a, b, n_a, n_b): all pairs of near words, each once."""
    lists = stage(_lists(words, known), "lists")
    short = lists.where(~F.col("longer")).select("list", F.col("word").alias("a"), F.col("n").alias("n_a"))
    every = lists.select("list", "longer", F.col("word").alias("b"), F.col("n").alias("n_b"))
    met = short.join(every, "list").where(F.col("longer") | (F.col("a") < F.col("b")))
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "b", "n_a", "n_b").distinct()


# ---------------------------------------------------------------- forms


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every (word, form), following forms to the last."""
    links = stage(forms.select("word", F.col("form").alias("root")), "links-0")
    number = 0
    while True:
        number += 1
        next_ = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = links.join(next_, "root", "left")
        longer = stage(longer.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), f"links-{number}")
        links = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return links


def group(docs: DataFrame, key: str = "doc_id", text: str = "text", most_frequent: int = MOST_FREQUENT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word."""
    words = stage(counted_words(docs, key, text), "words")
    pairs = stage(near_pairs(words, dictionary(words, most_frequent)), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("n_a").alias("own"), F.col("b").alias("near"), F.col("n_b").alias("n_of")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("n_b").alias("own"), F.col("a").alias("near"), F.col("n_a").alias("n_of"))
    )
    # most occurrences first, then the smallest word: UTF-8 sorts as code points do
    best = F.min(F.struct((-F.col("n_of")).alias("minus"), F.col("near").alias("near")))
    found = both.groupBy("word").agg(F.count("*").alias("n_near"), F.first("own").alias("own"), best.alias("best"))
    enough = -F.col("best.minus") >= FORM_FACTOR * F.col("own")
    found = stage(
        found.select(
            "word",
            "n_near",
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.minus")).alias("form_n"),
        ),
        "forms",
    )
    followed = roots(found.where(F.col("form").isNotNull()))
    full = words.join(found, "word", "left").join(followed, "word", "left")
    return full.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        "form_n",
    )
