"""The pipeline's stages on a small corpus, each against a plain version of itself."""

import random

import pytest

import corpus_pipeline
from platewise.llm import chunk_table
from platewise.llm.queries import piece_model
from platewise.session import stage

TEXT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    chance = random.Random(3)
    words = lambda n: [f"w{chance.randrange(500)}" for _ in range(n)]
    passage = " ".join(words(150))
    rows, labels = [], []
    for i in range(240):
        toxic = i % 8 == 0
        body = words(chance.randint(30, 80)) + chance.choices(["nasty", "vile", "gross"], k=4) * toxic
        chance.shuffle(body)
        text = " ".join(body)
        if i in (101, 103):
            text = f"{text}\n{passage}\n{' '.join(words(20))}"
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, int(toxic)))
    copy = rows[11][1].rsplit(" ", 1)[0] + " other"
    rows += [(900, copy, "en", "s0", len(copy)), (901, rows[11][1], "en", "s1", 0), (902, None, None, None, None), (903, "", "en", "s1", 0)]
    rows += [(12, *rows[13][1:]), rows[15]]
    place = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, TEXT).write.parquet(str(place / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(place / "labels.parquet"))
    return str(place)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, folder), name)
        seen[name] = docs.collect()
        if name != "sentencepiece":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    ids = {name: sorted(r["doc_id"] for r in rows) for name, rows in seen.items()}
    clean = [i for i in range(240) if i % 8]
    assert ids["toxicity"] == sorted(clean + [12, 15, 900, 901, 902, 903])
    # 900 and 901 are copies of 11, the second 12 is a copy of 13, the second 15 of the first
    assert sorted(ids["near-duplicates"]) == sorted([i for i in clean if i != 13] + [12, 902, 903])
    assert not {900, 901} & set(ids["near-duplicates"])
    assert ids["repeated-bytes"] == ids["near-duplicates"]
    before = {(r["doc_id"], r["n_chars"]): r["text"] for r in seen["near-duplicates"]}
    changed = [r["doc_id"] for r in seen["repeated-bytes"] if (r["doc_id"], r["n_chars"]) not in before]
    assert sorted(changed) == [101, 103]
    assert all(r["n_chars"] == len(r["text"]) for r in seen["repeated-bytes"] if r["doc_id"] in changed)
    size = lambda rows: sum(len((r["text"] or "").split()) for r in rows)
    assert size(seen["mixing"]) == pytest.approx(1.5 * size(seen["repeated-bytes"]), abs=4)
    assert {r["doc_id"] for r in seen["mixing"]} <= set(ids["repeated-bytes"]) - {902, 903}
    library = chunk_table.load(piece_model())
    texts = sorted(r["text"] for r in seen["mixing"])
    assert sorted(r["text"] for r in seen["sentencepiece"]) == texts
    assert all(r["ids"] == [*library.encode(r["text"]), library.eos_id()] for r in seen["sentencepiece"])


@pytest.mark.parametrize("size", [50, 51, 55, 60])
def test_passages_of_over_50_words_are_cut(spark, size):
    chance = random.Random(size)
    word = lambda: f"w{chance.randrange(9000)}"
    passage = " ".join(word() for _ in range(size))
    rows = []
    for i in range(6):
        before, after = ([word() for _ in range(150)] for _ in range(2))
        text = "\n".join([" ".join(before), passage * (i < 2), " ".join(after)])
        rows.append((i, text, "en", "s", len(text)))
    assert len(passage) < 400
    got = corpus_pipeline.drop_repeated_bytes(spark, spark.createDataFrame(rows, TEXT), "").collect()
    left = {r["doc_id"]: len(r["text"].split()) for r in got}
    assert left == {i: 300 + size * (i < 2 and size < 51) for i in range(6)}
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_rows_without_words_and_without_ids_stay(spark):
    rows = [(None, None, "en", "a", 0), (None, "", "en", "b", 0), (None, " \n", "en", "c", 2), (None, None, "en", "d", None)]
    rows += [(1, "one two three", "en", "a", 13), (1, "one two three", "fr", "b", 13), (2, None, "en", "a", 0)]
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, TEXT), "")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, rows[:5] + rows[6:]))
    assert corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame([], TEXT), "").count() == 0


def test_characters_of_the_input_survive_a_cut(spark):
    """A replacement character of the input stays; of a character that a cut halves nothing does."""
    passage = "\u00e9" * 260
    # \u00e9 and \u00e8 begin with the same byte, so the repeated bytes end inside a character
    rows = [(1, f"caf\ufffd one {passage}\u00e8 two\U0001F600"), (2, f"x {passage}\u00e9 \ufffd y\u20ac")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], TEXT)
    got = {r["doc_id"]: r for r in corpus_pipeline.drop_repeated_bytes(spark, docs, "").collect()}
    assert got[1]["text"].startswith("caf\ufffd one") and got[1]["text"].endswith("two\U0001F600")
    assert got[2]["text"].startswith("x ") and got[2]["text"].endswith("\ufffd y\u20ac")
    assert all("\u00e9" * 50 not in r["text"] and r["n_chars"] == len(r["text"]) for r in got.values())


def test_run_is_registered():
    import __spark_entry__ as contract

    assert contract.queries()["pipeline"] is corpus_pipeline.run and len(corpus_pipeline.STAGES) == 5
