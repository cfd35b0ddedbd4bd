"""Operator 9: quality rules. A table of thresholds becomes one projection, without user functions.

Null texts are empty. An empty text has no words and fails. Repeated rows and equal ids are judged
one by one; columns other than the id and the text are not read. Window equality is that of 64-bit
hashes within one document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import with_value, words

WINDOW = 5

# Frequent function words of the four languages.
STOP_WORDS = (
    "a and as be by for in is it of on or that the this to was with "
    "au ce dans de des du en est et il la le les ne ou par pas pour qui que sur un une "
    "auf das dem den der die ein eine er für im ist mit nicht sich sie und von zu "
    "al como con del el es lo los las más no para por se su una y"
).split()


@dataclass(frozen=True)
class Rule:
    """One line of the threshold table: a ratio of two measures, and the range that passes."""

    name: str
    over: str
    under: str | None = None
    low: float | None = None
    high: float | None = None
    # texts of fewer words pass: a ratio says little about them
    from_words: int = 0

    def passes(self) -> Column:
        value = F.col(self.over) if self.under is None else F.col(self.over) / F.nullif(F.col(self.under), F.lit(0))
        tests = []
        if self.low is not None:
            tests.append(value >= self.low)
        if self.high is not None:
            tests.append(value <= self.high)
        both = tests[0] if len(tests) == 1 else tests[0] & tests[1]
        return (F.coalesce(both, F.lit(False)) | (F.col("n_words") < self.from_words)).alias(self.name)


THRESHOLDS = (
    Rule("length_ok", "n_words", low=10),
    Rule("word_length_ok", "word_chars", "n_words", low=2, high=20),
    Rule("symbols_ok", "n_symbols", "n_words", high=0.1),
    Rule("stop_words_ok", "n_stop_words", "n_words", low=0.02, from_words=20),
    Rule("dup_lines_ok", "n_dup_lines", "n_lines", high=0.5),
    Rule("bullets_ok", "n_bullet_lines", "n_lines", high=0.9),
    Rule("ellipses_ok", "n_ellipsis_lines", "n_lines", high=0.3),
)


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more; only such documents are sorted."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = with_value(
        pairs,
        lambda s: F.transform(
            s,
            lambda x, k: F.when(
                F.coalesce((F.get(s, k - 1)["h"] == x["h"]), F.lit(False))
                | F.coalesce((F.get(s, k + 1)["h"] == x["h"]), F.lit(False)),
                x["i"],
            ),
        ),
    )
    starts = F.sort_array(F.filter(repeated, lambda i: i.isNotNull()))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        starts,
        zero,
        lambda a, i: F.struct(
            (i + WINDOW).alias("end"), (a["n"] + F.least(F.lit(WINDOW), i + WINDOW - a["end"])).alias("n")
        ),
        lambda a: a["n"],
    )
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered).otherwise(0)


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, ...), all long."""
    body = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(
        key,
        words(body).alias("words"),
        F.regexp_count(body, F.lit("[#*$%&|<>]")).alias("n_symbols"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
    )
    n = F.size("words")
    windows = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = split.select("*", windows.alias("hashes"))

    def lines_like(pattern: str) -> Column:
        return F.size(F.filter("lines", lambda line: line.rlike(pattern)))

    counted = {
        "n_words": n,
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.col("n_symbols"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _repeat_words(F.col("hashes")),
        "n_lines": F.size("lines"),
        "n_stop_words": F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))),
        "n_bullet_lines": lines_like("^[\\x20\\x09-\\x0D]*[-*•]"),
        "n_ellipsis_lines": lines_like("(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$"),
    }
    return hashed.select(key, *(value.cast("bigint").alias(name) for name, value in counted.items()))


def judge(measured: DataFrame, rules: tuple[Rule, ...] = THRESHOLDS) -> DataFrame:
    """Adds base_failed, one boolean per rule, and kept: no base failure and every rule passed."""
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    marked = measured.select("*", failed.alias("base_failed"), *(rule.passes() for rule in rules))
    kept = ~F.col("base_failed")
    for rule in rules:
        kept = kept & F.col(rule.name)
    return marked.withColumn("kept", kept)
