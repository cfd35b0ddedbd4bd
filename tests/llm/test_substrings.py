"""Operators 1 and 4 against brute force, on random texts full of copies."""

import random

import pytest
from pyspark.sql import functions as F

from platewise import session
from platewise.llm import rlz, suffix_dedup


def words_brute(rows, window):
    order = {}
    split = [(doc, (text or "").encode().split()) for doc, text in rows]
    last = 1 << 63
    for doc, words in split:
        for i in range(len(words) - window + 1):
            at = (last if doc is None else doc, i)
            content = tuple(words[i : i + window])
            order[content] = min(order.get(content, at), at)
    out = []
    for doc, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if order[tuple(words[i : i + window])] < (last if doc is None else doc, i):
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out.append((doc, len(words), len(gone), kept))
    return out


def bytes_brute(rows, window):
    count = {}
    data = [(doc, (text or "").encode()) for doc, text in rows]
    for _, body in data:
        for i in range(len(body) - window + 1):
            count[body[i : i + window]] = count.get(body[i : i + window], 0) + 1
    out = []
    for doc, body in data:
        gone = bytearray(len(body))
        for i in range(len(body) - window + 1):
            if count[body[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        runs = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(body)))
        out.append((doc, len(body), sum(gone), runs, bytes(b for b, g in zip(body, gone) if not g)))
    return out


def texts(seed, count=40, letters="ab"):
    chance = random.Random(seed)
    passages = [" ".join("".join(chance.choices(letters, k=chance.randint(1, 4))) for _ in range(60)) for _ in range(4)]
    out = []
    for _ in range(count):
        parts = []
        for _ in range(chance.randint(0, 4)):
            if chance.random() < 0.5:
                passage = chance.choice(passages).split(" ")
                start = chance.randint(0, 40)
                parts += passage[start : start + chance.randint(1, 60)]
            else:
                parts += ["".join(chance.choices("cdefgh", k=3)) for _ in range(chance.randint(0, 30))]
        out.append(chance.choice([" ", " ", "\n", "  "]).join(parts))
    return out


EDGE = [None, "", " \n ", "one", "é" * 900, "a " * 700, "xyz" * 400, "a " * 700]


@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, docs, seed):
    rows = [(i, text) for i, text in enumerate(texts(seed) + EDGE)] + [(None, "q w " * 40), (3, "r t y " * 30)]
    got = rlz.dedup(docs(rows), window=20).select("doc_id", "n_words", "n_removed", "kept")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(words_brute(rows, 20), key=repr)


def test_factors_are_copies(spark, docs):
    rows = list(enumerate(texts(5)))
    words = {doc: text.split() for doc, text in rows}
    found = 0
    for row in rlz.dedup(docs(rows)).collect():
        for factor in row["factors"]:
            own = words[row["doc_id"]][factor["start"] : factor["start"] + factor["words"]]
            ref = words[factor["ref"]][factor["ref_start"] : factor["ref_start"] + factor["words"]]
            assert own == ref and len(own) >= rlz.WINDOW
            assert (factor["ref"], factor["ref_start"]) < (row["doc_id"], factor["start"])
            found += 1
    assert found > 5


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, docs, seed):
    rows = [(i, text) for i, text in enumerate(texts(seed, letters="abcdefghijkl") + EDGE)]
    rows += [(None, "q w " * 140), (3, "r t y " * 130), (3, "r t y " * 130)]
    got = suffix_dedup.dedup(docs(rows)).selectExpr("doc_id", "n_bytes", "n_removed", "size(spans)", "kept")
    got = [(*row[:4], bytes(row[4])) for row in got.collect()]
    assert sorted(got, key=repr) == sorted(bytes_brute(rows, suffix_dedup.WINDOW), key=repr)


def test_positions_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def rows(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    schema = "id bigint, print bigint, number bigint, rounds bigint, phrase bigint"
    table = [(i, i, n, 1, n if i < 3 else 100 * i + n) for i in range(5) for n in range(4)]
    left = suffix_dedup.double(spark.createDataFrame(table, schema).mapInPandas(rows, schema))
    assert made.value == len(table)
    got = left.groupBy("rank").agg(F.collect_set("id").alias("ids"), F.countDistinct("number").alias("numbers")).collect()
    assert [(sorted(r["ids"]), r["numbers"]) for r in got] == [([0, 1, 2], 1)] * 3


def test_a_round_ranks_without_sorting(spark, monkeypatch):
    """Pairs of ranks get their new rank in their row: no range partitioning, numbering or broadcast for it."""
    staged = []

    def stage(df, label):
        staged.append((label, df._jdf.queryExecution().toString()))
        return session.stage(df, label)

    monkeypatch.setattr(suffix_dedup, "stage", stage)
    schema = "id bigint, print bigint, number bigint, rounds bigint, phrase bigint"
    table = [(i, i, n, 2, n if i < 3 else 100 * i + n) for i in range(5) for n in range(9)]
    left = suffix_dedup.double(spark.createDataFrame(table, schema))
    assert [label for label, _ in staged] == ["round-0", "round-1", "round-2"]
    assert not any("rangepartitioning" in plan for _, plan in staged)
    got = left.groupBy("rank").agg(F.collect_set("id").alias("ids"), F.countDistinct("number").alias("numbers")).collect()
    assert [(sorted(r["ids"]), r["numbers"]) for r in got] == [([0, 1, 2], 1)] * 6


def test_short_windows_are_refused(spark, docs):
    with pytest.raises(ValueError, match="three times"):
        suffix_dedup.dedup(docs([(1, "x")]), window=300)


@pytest.mark.parametrize("dedup", [rlz.dedup, suffix_dedup.dedup])
def test_empty_table(spark, docs, dedup):
    assert dedup(docs([])).count() == 0


def test_carried_columns(spark, docs):
    got = rlz.dedup(docs([(1, "a b"), (None, None)]), carry=["lang", "key"]).collect()
    assert sorted((r["lang"], r["key"]) for r in got) == [("en", "x")] * 2


def passages_brute(rows, size):
    """The words that no run of ``size`` words with a copy elsewhere covers."""
    split = [(text or "").encode().split() for _, text in rows]
    count = {}
    for words in split:
        for i in range(len(words) - size + 1):
            count[tuple(words[i : i + size])] = count.get(tuple(words[i : i + size]), 0) + 1
    gone = [set() for _ in split]
    for at, words in enumerate(split):
        for i in range(len(words) - size + 1):
            if count[tuple(words[i : i + size])] > 1:
                gone[at].update(range(i, i + size))
    return [(doc, b" ".join(w for i, w in enumerate(words) if i not in cut)) for (doc, _), words, cut in zip(rows, split, gone)]


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_of_words(spark, docs, seed):
    chance = random.Random(seed)
    passage = ["".join(chance.choices("abcde", k=chance.randint(1, 5))) for _ in range(62)]
    rows = []
    for i in range(60):
        body = ["".join(chance.choices("fghij", k=4)) for _ in range(chance.randint(0, 60))]
        at, first = chance.randint(0, len(body)), chance.randint(0, 9)
        body[at:at] = passage[first : first + chance.choice([0, 49, 50, 51, 52, 55])]
        rows.append((i, chance.choice([" ", "\n", "  "]).join(body)))
    rows += [(100 + i, text) for i, text in enumerate(EDGE) if not text or len(text.split()) != 1] + [(None, " ".join(passage))]
    got = suffix_dedup.dedup(docs(rows), words=51).selectExpr("doc_id", "kept")
    got = [(doc, b" ".join(bytes(kept).split())) for doc, kept in got.collect()]
    assert sorted(got, key=repr) == sorted(passages_brute(rows, 51), key=repr)


def test_long_words_keep_the_byte_window(spark, docs):
    rows = [(1, "p" * 5 + "xyz" * 400), (2, "q " + "xyz" * 400), (3, "a b c " * 20)]
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.dedup(docs(rows), words=51).collect()}
    assert got == {1: 1200, 2: 1200, 3: len("a b c " * 20) - 1}


def test_texts_under_one_id_are_told_apart(spark, docs):
    # two texts of unlike lengths whose fingerprints have the low 23 bits in common
    p, q = (" ".join(f"{s}{n}x" for n in range(130)) for s in "pq")
    pairs = spark.range(40_000).selectExpr(
        f"CASE WHEN id % 2 = 0 THEN concat('{p} ', id) ELSE concat('{q} {q[::-1]} ', id) END AS t"
    ).selectExpr("t", "xxhash64(t) & 8388607 AS h").groupBy("h").agg(F.collect_list("t").alias("t")).where("size(t) = 2")
    a, b = next(sorted(r["t"], key=len) for r in pairs.orderBy("h").collect() if len(r["t"][0]) // 300 != len(r["t"][1]) // 300)
    rows = [(None, a), (None, b), (1, p), (2, q[::-1] + " end")]
    got = rlz.dedup(docs(rows), window=20).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(words_brute(rows, 20), key=repr)
    got = suffix_dedup.dedup(docs(rows)).selectExpr("doc_id", "n_bytes", "n_removed", "size(spans)", "kept")
    got = [(*row[:4], bytes(row[4])) for row in got.collect()]
    assert sorted(got, key=repr) == sorted(bytes_brute(rows, suffix_dedup.WINDOW), key=repr)
