"""Operator 3: classes against brute force, signatures against the exact coefficient."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from platewise.llm import bagminhash


def bag(text):
    words = (text or "").encode().split()
    size = min(5, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else Counter()


def brute(rows):
    bags = [bag(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        either = sum((bags[i] | bags[j]).values())
        if bags[i] and bags[j] and sum((bags[i] & bags[j]).values()) >= 0.8 * either:
            root[find(j)] = find(i)
    lows = {}
    for i, (doc, _) in enumerate(rows):
        lows.setdefault(find(i), []).append(doc)
    return sorted((doc, min((x for x in lows[find(i)] if x is not None), default=None), len(lows[find(i)])) for i, (doc, _) in enumerate(rows))


def rows_of(seed):
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, number = [], 0
    for _ in range(12):
        base = chance.choices(vocabulary, k=chance.randint(3, 120))
        for _ in range(chance.randint(1, 9)):
            words = list(base)
            for _ in range(chance.randint(0, 4)):
                words[chance.randrange(len(words))] = chance.choice(vocabulary)
            rows.append((number, " ".join(words)))
            number += 1
    return rows + [(number, None), (number + 1, ""), (number + 2, " \n"), (0, rows[0][1]), (number + 3, "a " * 3000), (number + 4, "a " * 2900)]


@pytest.mark.parametrize("small", [32, 1])
def test_classes(spark, docs, monkeypatch, small):
    monkeypatch.setattr(bagminhash, "SMALL_BUCKET", small)
    monkeypatch.setattr(bagminhash, "BLOCK_NODES", 3)
    rows = rows_of(small)
    got = bagminhash.classes(docs(rows)).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_empty_table(spark, docs):
    assert bagminhash.classes(docs([])).count() == 0


def test_signatures_are_unbiased():
    rng = np.random.default_rng(3)
    elements = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    a, b = rng.integers(1, 9, 40), rng.integers(1, 9, 40)
    one, two = elements[:40], elements[20:]
    doc = np.repeat([0, 1], 40)
    h = bagminhash.signatures(doc, np.concatenate((one, two)), np.concatenate((a, b)), 2, 4096)
    common = np.minimum(a[20:], b[:20]).sum()
    exact = common / (a.sum() + b.sum() - common)
    assert (h[0] == h[1]).mean() == pytest.approx(exact, abs=4 * (exact * (1 - exact) / 4096) ** 0.5)


def test_block_overlaps():
    sets = [np.array(x, np.uint64) for x in ([1, 2, 3], [2, 3, 4, 5], [9], [])]
    expected = [[len(set(x.tolist()) & set(y.tolist())) for y in sets] for x in sets]
    assert bagminhash.overlaps(sets, sets).tolist() == expected
