"""Operator 10: licence scans by the Dice coefficient over word bigrams.

Every whole text and every line of it is a candidate, and so is every run of words that starts with a
bigram of the template and is of about its length: a notice may be wrapped over lines or stand among
other words. Runs are looked at only in texts that hold as many bigrams of the template as a match needs. Candidates and templates are normalised alike:
lower case, anything but letters and digits becomes a blank. Two bigram sets of sizes a and b can
reach a Dice coefficient t only if a and b differ by a factor of at most (2 - t) / t, so templates
outside these bounds are never compared. All of it is one projection over a fixed template table.

Null and empty texts match nothing, nor do candidates of a single word. Repeated rows and equal ids
are scanned one by one; of equal scores the template that comes first by name wins; columns other
than the id and the text are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import with_value

DICE = 0.8

# Notices by which public licences are usually named or granted.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License."
    ),
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction.'
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

MARKS = "[^\\p{L}\\p{N}]+"


def template_bigrams(text: str) -> list[str]:
    tokens = re.sub(r"[\W_]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(tokens, tokens[1:])})


def bigrams(text: Column) -> Column:
    """Distinct word bigrams of a normalised text."""
    return F.array_distinct(_in_order(text))


def _in_order(text: Column) -> Column:
    """All word bigrams of a normalised text, as they follow each other."""
    tokens = F.array_remove(F.split(F.lower(text), MARKS), "")
    return with_value(
        tokens,
        lambda t: F.transform(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", F.get(t, i), w)),
    )


def _runs(text: Column, compared: list[tuple[str, list[str]]], dice: float) -> Column:
    """Array of (score, license) of the templates that a run of words reaches, each with its best run."""
    every = F.array(*map(F.lit, sorted({gram for _, grams in compared for gram in grams})))

    def best(all_grams: Column, held: Column, name: str, grams: list[str]) -> Column:
        # a match shares at least as many bigrams as the smallest set that can match has
        need, most = max(1, _least(len(grams), dice)), _most(len(grams), dice)
        wanted = F.array(*map(F.lit, grams))

        def score(run: Column) -> Column:
            unit = F.array_distinct(run)
            return F.lit(2.0) * F.size(F.array_intersect(unit, wanted)) / (F.size(unit) + len(grams))

        def longest(gram: Column, at: Column) -> Column:
            reach = F.slice(all_grams, at + 1, most)
            near = F.array_contains(wanted, gram) & (F.size(F.array_intersect(reach, wanted)) >= need)
            sizes = F.sequence(F.lit(need), F.lit(most))
            return F.when(near, F.array_max(F.transform(sizes, lambda n: score(F.slice(reach, F.lit(1), n)))))

        top = F.array_max(F.transform(all_grams, longest))
        pair = with_value(top, lambda x: F.when(x >= dice, F.struct(x.alias("score"), F.lit(name).alias("license"))))
        return F.when(F.size(F.array_intersect(held, wanted)) >= need, pair)

    def of(all_grams: Column) -> Column:
        held = F.array_intersect(all_grams, every)
        return with_value(held, lambda h: F.filter(F.array(*(best(all_grams, h, *one) for one in compared)), lambda x: x.isNotNull()))

    return with_value(_in_order(text), of)


def _matches(unit: Column, compared: list[tuple[str, list[str]]], dice: float) -> Column:
    """Array of (score, license) of the templates that reach ``dice`` for one candidate's bigrams."""
    scores = []
    for name, grams in compared:
        near = F.size(unit).between(_least(len(grams), dice), _most(len(grams), dice))
        wanted = F.array(*map(F.lit, grams))
        score = F.lit(2.0) * F.size(F.array_intersect(unit, wanted)) / (F.size(unit) + len(grams))
        pair = F.when(near, F.struct(score.alias("score"), F.lit(name).alias("license")))
        scores.append(F.when(pair["score"] >= dice, pair))
    return F.filter(F.array(*scores), lambda x: x.isNotNull())


def _least(size: int, dice: float) -> int:
    return int(size * dice / (2 - dice))  # rounded down: no template is pruned wrongly


def _most(size: int, dice: float) -> int:
    return int(size * (2 - dice) / dice) + 1


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    dice: float = DICE,
    templates: dict[str, str] | None = None,
) -> DataFrame:
    """(key, licenses, license, score): names found in order, the best one, and its coefficient.

    The template table belongs to the plan, so it should stay at tens of notices. Every row comes
    back; a text without licence has an empty list and nulls.
    """
    templates = TEMPLATES if templates is None else templates
    compared = [(name, template_bigrams(body)) for name, body in sorted(templates.items())]
    compared = [(name, grams) for name, grams in compared if grams]
    body = F.coalesce(F.col(text), F.lit(""))
    if not compared:
        empty = docs.select(key, F.array().cast("array<string>").alias("licenses"))
        return empty.select("*", F.lit(None).cast("string").alias("license"), F.lit(None).cast("double").alias("score"))
    sizes = [len(grams) for _, grams in compared]
    low, high = _least(min(sizes), dice), _most(max(sizes), dice)
    # A candidate of more words than any template allows cannot match: the count is cheap, the set is not.
    lines = F.split(body, "\n")
    whole = F.when(F.size(lines) > 1, F.array(F.regexp_replace(body, "\n", " "))).otherwise(F.array())
    units = F.concat(lines, whole.cast("array<string>"))
    # n bigrams that differ need n + 1 words, each but the last followed by a mark
    few = F.filter(units, lambda u: (F.length(u) >= 2 * low + 1))
    grams = F.transform(few, bigrams)
    fitting = F.filter(grams, lambda g: F.size(g).between(max(low, 1), high))
    found = F.flatten(F.transform(fitting, lambda g: with_value(g, lambda u: _matches(u, compared, dice))))
    found = F.concat(found, _runs(body, compared, dice))
    hits = docs.select(key, found.alias("found"))
    best = F.element_at(
        F.array_sort("found", lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1)
                     .when(a["license"] < b["license"], -1).when(a["license"] > b["license"], 1).otherwise(0)), 1)
    names = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["license"])))
    marked = hits.select(key, names.alias("licenses"), F.when(F.size("found") > 0, best).alias("best"))
    return marked.select(key, "licenses", F.col("best.license").alias("license"), F.col("best.score").alias("score"))
