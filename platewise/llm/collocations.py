"""Operator 12: phrase collocations by best-first branch-and-bound growth.

A text is lower-cased (A-Z only), split into pieces at ``.,;:!?`` and the breaks \\x0A-\\x0D, and a piece
into words, runs of anything but space and tab. Everything is counted by language. A phrase of two or
three words that occurs a >= ``LEAST`` times is a candidate; its score is floor(1,000,000 a a / (l r)) for
the cut into a first part with l and a rest with r occurrences that scores lowest (ties: shortest first
part). A candidate that stands inside a longer one with at least half of its occurrences is dropped. The
first ``KEEP`` of every language by score, occurrences and phrase are the result.

Phrases grow from the counts of what they begin with. A phrase occurs no more often than any part of it,
so with f the counts of its words its score is at most

    two words    1,000,000 min(f1, f2) / max(f1, f2)
    three words  1,000,000 min(f1, f2, f3) / max(f1, f3)

For each language there is a bound B, at first high. A round counts the phrases whose own bound reaches B,
the frontier, and then only what these need: the two-word parts of three-word candidates that can still
reach B, and the three-word phrases around two-word candidates that do. All candidates with a score of B
or more are then known, and which of them survive. A language with ``KEEP`` survivors is settled: none
that scores less can come before them, and all ties of the last one are among them. For the others the
bound is lowered (``BOUNDS``), at last to 0, where every phrase is counted.

Tasks know word counts from a table of ``BUCKETS`` entries that keeps the least and greatest count of the
words that share a bucket, in steps of an eighth of a doubling rounded outwards, so the bounds hold
whatever the corpus. Words are 64-bit hashes of language and word; the vocabulary shows
whether two words of the corpus share one, and another seed is taken then, so counts are exact. Scores are
computed in 38 decimal digits, enough for 10^16 occurrences.

Null and empty texts have no words; a null language counts as ``und``. Texts of any length are read
whole, and repeated rows count as often as they stand there. An empty table, or a language without
candidates, gives no rows. Columns other than the text and the language are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platewise.llm.rolling import mix
from platewise.session import stage

LEAST = 10
KEEP = 2000
# A longer phrase covers a shorter one from this share of its occurrences on.
COVER_PERCENT = 50
# Scores that the rounds go down to, in millionths.
BOUNDS = (500_000, 60_000, 4_000, 0)
BUCKETS = 1 << 20
FLAG_BITS = 22

# What ends a piece, and what ends a word.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
_BREAK = b"\xff"  # no byte of any UTF-8 text
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PLAIN = bytes.maketrans(_UPPER + PIECE_ENDS + b"\t", _UPPER.lower() + _BREAK * len(PIECE_ENDS) + b" ")

_WORDS_AT_ONCE = 1 << 20
_MOST_NAMES = 1 << 18
# Counts in a task's table are rounded to eighths of a doubling.
_STEPS = 8
_NONE = -(1 << 14)


def words_of(text: bytes) -> list[bytes]:
    """Words in order, with a break after every piece."""
    return text.translate(_PLAIN).replace(_BREAK, b" " + _BREAK + b" ").split()


class _Names(dict):
    """Hash of every word of a language met so far; the break is 0."""

    def __init__(self, lang: str, seed: int):
        super().__init__({_BREAK: 0})
        self.start, self.seed = lang.encode() + b"\0", seed

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(self.start + word, self.seed) or 1
        found -= (found >> 63) << 64
        if len(self) >= _MOST_NAMES:
            self.clear()
            self[_BREAK] = 0
        self[word] = found
        return found


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    texts, langs = batch.column(0), batch.column(1).to_pylist()
    for place, lang in enumerate(langs):
        yield lang, texts[place].as_buffer().to_pybytes()


def _source(docs: DataFrame, text: str, lang: str) -> DataFrame:
    body = F.col(text).cast("binary").alias("text")
    return docs.where(F.length(text) > 0).select(body, F.coalesce(F.col(lang), F.lit("und")).alias("lang"))


def vocabulary(source: DataFrame, seed: int) -> DataFrame:
    """(h, lang, word, f, clash): every word of every language; ``clash`` where two share a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        held = 0

        def flush():
            for lang, words in counts.items():
                names = _Names(lang, seed)
                keys = list(words)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[word] for word in keys], pa.int64()),
                        pa.array([lang] * len(keys), pa.string()),
                        pa.array(keys, pa.binary()).cast(pa.string()),
                        pa.array([words[word] for word in keys], pa.int64()),
                    ],
                    ["h", "lang", "word", "n"],
                )

        for batch in batches:
            for lang, text in _by_lang(batch):
                words = counts.setdefault(lang, Counter())
                before = len(words)
                words.update(words_of(text))
                words.pop(_BREAK, None)
                held += len(words) - before
                if held > _MOST_NAMES:
                    yield from flush()
                    counts, held = {}, 0
        yield from flush()

    counted = source.mapInArrow(run, "h bigint, lang string, word string, n bigint")
    name = F.struct("lang", "word")
    merged = counted.groupBy("h").agg(F.min(name).alias("name"), F.max(name).alias("other"), F.sum("n").alias("f"))
    return merged.select("h", "name.lang", "name.word", "f", (F.col("name") != F.col("other")).alias("clash"))


def count_table(frequent: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest count of the words in every bucket, as rounded logarithms; ``_NONE`` for no word."""
    # at most BUCKETS rows, whatever the corpus
    bucket = F.col("h").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("bucket")
    rows = frequent.groupBy(bucket).agg(F.min("f").alias("low"), F.max("f").alias("high")).toArrow()
    low, high = np.full(BUCKETS, _NONE, np.int16), np.full(BUCKETS, _NONE, np.int16)
    at = rows.column("bucket").to_numpy()
    low[at] = np.floor(_STEPS * np.log2(rows.column("low").to_numpy()))
    high[at] = np.ceil(_STEPS * np.log2(rows.column("high").to_numpy()))
    return low, high


def _steps(bound: int) -> int:
    """A bound's logarithm, rounded down; below all others for 0."""
    return math.floor(_STEPS * math.log2(bound / 1_000_000)) - 1 if bound else 2 * _NONE


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A number for two hashes in order, the same as ``pair_column``."""
    with np.errstate(over="ignore"):
        return ((first * np.int64(31) + second) ^ (first >> np.int64(29))) & np.int64((1 << FLAG_BITS) - 1)


def pair_column(first: str, second: str) -> Column:
    """``pair_key`` of two columns: only low bits are kept, so overflow is avoided by taking them first."""
    mask = F.lit((1 << 40) - 1)
    low = F.col(first).bitwiseAND(mask) * 31 + F.col(second).bitwiseAND(mask)
    return low.bitwiseXOR(F.shiftright(first, 29)).bitwiseAND(F.lit((1 << FLAG_BITS) - 1))


def flags(pairs: DataFrame) -> np.ndarray:
    """A bit for every pair key of the pairs (u, v): a filter of fixed size, in bytes of eight."""
    # Spark's bitmaps begin with 1
    key = pairs.select((pair_column("u", "v") + 1).alias("key"))
    kept = key.groupBy(F.bitmap_bucket_number("key").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits")
    )
    out = np.zeros(1 << (FLAG_BITS - 3), np.uint8)
    for row in kept.collect():  # 2^FLAG_BITS / 32768 rows at most, whatever the number of pairs
        bits = np.frombuffer(bytes(row["bits"]), np.uint8)
        start = (row["part"] - 1) * len(bits)
        out[start : start + len(bits)] = bits
    return out


def flagged(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    return (bits[key >> 3] >> (key & 7).astype(np.uint8)) & 1 > 0


def _summed(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows and how often each stands there."""
    with np.errstate(over="ignore"):
        key = np.zeros(len(columns[0]), np.uint64)
        for column in columns:
            key = mix(key + column.view(np.uint64))
    order = np.argsort(key, kind="stable")
    columns = [column[order] for column in columns]
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for column in columns:
        fresh[1:] |= column[1:] != column[:-1]
    starts = np.flatnonzero(fresh)
    return [column[starts] for column in columns], np.diff(np.concatenate((starts, [len(order)])))


def _scan(source: DataFrame, seed: int, pick) -> DataFrame:
    """(h1, h2, h3, a): counted phrases; ``pick`` says which words start a pair or a triple that counts.

    A pair has 0 in place of its third word.
    """

    def counted(lang: str, held: list[list[int]]) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate(held)
        pairs, triples = pick(lang, ids)
        i = np.flatnonzero(pairs)
        j = np.flatnonzero(triples)
        second = np.concatenate((ids[i + 1], ids[j + 1]))
        third = np.concatenate((np.zeros(len(i), np.int64), ids[j + 2]))
        rows, counts = _summed([np.concatenate((ids[i], ids[j])), second, third])
        for at in range(0, len(counts), 100_000):
            part = [pa.array(column[at : at + 100_000]) for column in (*rows, counts)]
            yield pa.RecordBatch.from_arrays(part, ["h1", "h2", "h3", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, _Names] = {}
        held: dict[str, list] = {}
        total = 0
        for batch in batches:
            for lang, text in _by_lang(batch):
                if lang not in names:
                    if len(names) >= 64:
                        names.clear()
                    names[lang] = _Names(lang, seed)
                words = words_of(text)
                found = np.fromiter(map(names[lang].__getitem__, words), np.int64, len(words))
                held.setdefault(lang, []).append(np.append(found, [0, 0]))
                total += len(words)
                if total >= _WORDS_AT_ONCE:
                    for one, ids in held.items():
                        yield from counted(one, ids)
                    held, total = {}, 0
        for one, ids in held.items():
            yield from counted(one, ids)

    counted_rows = source.mapInArrow(run, "h1 bigint, h2 bigint, h3 bigint, n bigint")
    return counted_rows.groupBy("h1", "h2", "h3").agg(F.sum("n").alias("a")).where(F.col("a") >= LEAST)


def _logs(table: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest logarithm for every word; a break or a rare word has ``_NONE`` for both."""
    at = ids & np.int64(BUCKETS - 1)
    low, high = table[0][at].astype(np.int32), table[1][at].astype(np.int32)
    low[ids == 0] = high[ids == 0] = _NONE
    return low, high


def _within(low: np.ndarray, high: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a pair, and where a triple starts whose bound may reach that of ``steps``."""
    known = low > _NONE
    pairs, triples = np.zeros(len(low), bool), np.zeros(len(low), bool)
    near = (high[1:] - low[:-1] >= steps) & (high[:-1] - low[1:] >= steps)
    pairs[:-1] = known[:-1] & known[1:] & near
    ends = np.maximum(low[:-2], low[2:])
    least = np.minimum(np.minimum(high[:-2], high[2:]), high[1:-1])
    triples[:-2] = known[:-2] & known[1:-1] & known[2:] & (least - ends >= steps)
    return pairs, triples


def _frontier(table, steps: dict[str, int]):
    def pick(lang, ids):
        return _within(*_logs(table, ids), steps[lang])

    return pick


def _needed(table, steps: dict[str, int], parts: np.ndarray, tops: np.ndarray):
    """What the frontier's candidates need and the frontier did not count."""

    def pick(lang, ids):
        low, high = _logs(table, ids)
        known = low > _NONE
        pairs, triples = _within(low, high, steps[lang])
        key = np.zeros(len(ids), np.int64)
        key[:-1] = pair_key(ids[:-1], ids[1:])
        both = np.zeros(len(ids), bool)
        both[:-1] = known[:-1] & known[1:]
        more = both & ~pairs & flagged(parts, key)
        top = both & flagged(tops, key)
        around = np.zeros(len(ids), bool)
        around[:-2] = both[:-2] & both[1:-1] & (top[:-2] | top[1:-1]) & ~triples[:-2]
        return more, around

    return pick


def _big(name: str) -> Column:
    return F.col(name).cast("decimal(38,0)")


def _score(first: str, rest: str) -> Column:
    return F.expr(
        f"(1000000BD * cast(a AS decimal(38,0)) * cast(a AS decimal(38,0))) div "
        f"(cast({first} AS decimal(38,0)) * cast({rest} AS decimal(38,0)))"
    )


def _with_counts(phrases: DataFrame, frequent: DataFrame, numbers: list[int]) -> DataFrame:
    """Adds f<i> and word<i> of the phrase's words, and their language."""
    for i in numbers:
        names = [F.col("h").alias(f"h{i}"), F.col("f").alias(f"f{i}"), F.col("word").alias(f"word{i}")]
        phrases = phrases.join(frequent.select(*names, *["lang"] * (i == 1)), f"h{i}")
    return phrases


def _round(source: DataFrame, frequent: DataFrame, table, bounds: dict[str, int], seed: int, label: str) -> DataFrame:
    """(lang, phrase, a, l, r, score): all survivors whose score reaches their language's bound."""
    steps = {lang: _steps(bound) for lang, bound in bounds.items()}
    spark = source.sparkSession
    open_ = F.broadcast(spark.createDataFrame(sorted(bounds.items()), "lang string, bound bigint"))
    source = source.join(open_.select("lang"), "lang", "left_semi").select("text", "lang")
    grown = stage(_scan(source, seed, _frontier(table, steps)), f"{label}-grown")

    pairs = _with_counts(grown.where("h3 = 0").drop("h3"), frequent, [1, 2]).join(open_, "lang")
    pairs = pairs.withColumn("score", _score("f1", "f2")).where(F.col("score") >= F.col("bound"))
    pairs = stage(pairs, f"{label}-pairs")

    triples = _with_counts(grown.where("h3 <> 0"), frequent, [1, 2, 3]).join(open_, "lang")
    able = 1_000_000 * _big("a") >= F.col("bound") * F.greatest(_big("f1"), _big("f3"))
    triples = stage(triples.where(able), f"{label}-triples")
    parts = triples.select(F.col("h1").alias("u"), F.col("h2").alias("v")).unionByName(
        triples.select(F.col("h2").alias("u"), F.col("h3").alias("v"))
    )
    parts, tops = flags(parts), flags(pairs.select(F.col("h1").alias("u"), F.col("h2").alias("v")))
    more = stage(_scan(source, seed, _needed(table, steps, parts, tops)), f"{label}-more")

    counted = stage(grown.unionByName(more), f"{label}-counted")
    two = counted.where("h3 = 0").select("h1", "h2", F.col("a").alias("c"))
    begin = two.select("h1", "h2", F.col("c").alias("l2"))
    end = two.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("c").alias("r2"))
    triples = triples.join(begin, ["h1", "h2"]).join(end, ["h2", "h3"])
    triples = triples.withColumn("cut1", _score("f1", "r2")).withColumn("cut2", _score("l2", "f3"))
    triples = triples.withColumn("score", F.least("cut1", "cut2")).where(F.col("score") >= F.col("bound"))
    first = F.col("cut1") <= F.col("cut2")
    triples = triples.select(
        "lang",
        F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"),
        "a",
        F.when(first, F.col("f1")).otherwise(F.col("l2")).alias("l"),
        F.when(first, F.col("r2")).otherwise(F.col("f3")).alias("r"),
        "score",
    )
    three = counted.where("h3 <> 0")
    inside = three.select("h1", "h2", F.col("a").alias("longer")).unionByName(
        three.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), F.col("a").alias("longer"))
    )
    inside = stage(inside.groupBy("h1", "h2").agg(F.max("longer").alias("longer")), f"{label}-inside")
    covered = 100 * F.coalesce("longer", F.lit(0)) >= COVER_PERCENT * F.col("a")
    pairs = pairs.join(inside, ["h1", "h2"], "left").where(~covered)
    pairs = pairs.select(
        "lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), "score"
    )
    return stage(pairs.unionByName(triples), f"{label}-survivors")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", keep: int = KEEP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``keep`` phrases of every language."""
    source = _source(docs, text, lang)
    seed = 0
    while True:
        words = stage(vocabulary(source, seed), f"vocabulary-{seed}")
        if words.where("clash").isEmpty():
            break
        seed += 1
    sizes = stage(words.groupBy("lang").agg(F.sum("f").alias("n")), "sizes")
    frequent = stage(words.where(F.col("f") >= LEAST).select("h", "lang", "word", "f"), "frequent")
    table = count_table(frequent)
    unsettled = [row["lang"] for row in frequent.select("lang").distinct().collect()]
    found = None
    for number, bound in enumerate(BOUNDS):
        if not unsettled:
            break
        survivors = _round(source, frequent, table, dict.fromkeys(unsettled, bound), seed, f"round{number}")
        counts = survivors.groupBy("lang").count().where(F.col("count") >= keep)
        settled = set(unsettled) if not bound else {row["lang"] for row in counts.collect()}
        part = survivors.where(F.col("lang").isin(sorted(settled)))
        found = part if found is None else found.unionByName(part)
        unsettled = [one for one in unsettled if one not in settled]
    if found is None:
        found = source.sparkSession.createDataFrame(
            [], "lang string, phrase string, a bigint, l bigint, r bigint, score bigint"
        )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= keep)
    # one row for every language
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
