"""Operators 2 and 5 to 10, and the shared parts, on small cases."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from platewise.llm import chunk_table, common, cross_polytope, licenses, mixing, quality, toxicity, warc
from platewise.llm.queries import piece_model

PAGES = "page_id bigint, url string, html string, payload string, same string"


def test_components(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)]
    links = spark.createDataFrame([*chain, ("z", "y"), ("x", "y"), ("q", "q")], "a string, b string")
    got = {row["id"]: row["root"] for row in common.components(links).collect()}
    assert got == {f"n{i:03d}": "n000" for i in range(61)} | dict.fromkeys("xyz", "x")
    assert common.components(links.limit(0)).count() == 0


# ---------------------------------------------------------------- toxicity


def test_chain_holds_on_unseen_rows(spark, docs):
    chance = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        toxic, junk = i % 4 == 0, i % 7 == 0
        words = [f"w{chance.randrange(300)}" for _ in range(chance.randint(5, 60))]
        words += chance.choices(["nasty", "vile", "gross"], k=3) * toxic + ["### buy"] * junk
        chance.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(junk), int(toxic)))
    frame = docs(rows + [(9000, None), (9001, ""), (0, rows[0][1])])
    known = spark.createDataFrame(labels[:400] + [(1, None, 1)], "doc_id bigint, junk int, toxic int")
    chain = toxicity.fit(frame, known, ["junk", "toxic"])
    got = {row["doc_id"]: row for row in chain.score(frame).collect()}
    assert len(got) == 602 and chain.score(frame).count() == 603
    assert all((got[i]["p_toxic"] >= 0.5) == bool(toxic) for i, _, toxic in labels[400:])
    assert got[9000]["p_toxic"] == got[9001]["p_toxic"] < 0.5


def test_chain_scores_in_a_session_that_has_observed(spark, docs):
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 3}
    rows = [(i, f"word{i % 5} " + ("nasty vile" if i % 3 == 0 else "kind good")) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(60)], "doc_id bigint, junk int, toxic int")
    scored = toxicity.fit(docs(rows), labels, ["junk", "toxic"]).score(docs(rows)).collect()
    assert all((r["p_toxic"] >= 0.5) == (r["doc_id"] % 3 == 0) for r in scored)


def test_one_class_or_no_rows_give_a_constant(spark, docs):
    frame = docs([(1, "a b"), (2, None)])
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")
    assert {r["p_toxic"] for r in toxicity.fit(frame, labels, ["toxic"]).score(frame).collect()} == {1.0}
    assert {r["p_toxic"] for r in toxicity.fit(frame, labels.limit(0), ["toxic"]).score(frame).collect()} == {0.0}


def test_sample_is_bounded(spark):
    labels = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    assert toxicity.sample(labels, ["toxic"], rows=100).count() == 100


# ---------------------------------------------------------------- WARC


def test_archives_round_trip(spark, tmp_path):
    rows = [(i, f"http://h/{i} x\r\nEvil: 1", f"<p>{'text ' * (i % 5)}é</p>") for i in range(200)]
    rows += [(500, None, None), (501, "u", ""), (None, "n", None), (502, "u", "\x00\r\n\r\nWARC/1.1"), (700, "u", "twice"), (700, "u", "twice")]
    pages = spark.createDataFrame([(*row, "x", "y") for row in rows], PAGES)
    path = str(tmp_path / "archives")
    warc.write(pages, path, archive_bytes=20_000)
    got = {}
    for row in warc.read(spark, path).collect():
        got.setdefault(row["page_id"], []).append(row)
    assert sum(map(len, got.values())) == len(rows)
    firsts = {}
    for i, _, html in rows:
        payload = (html or "").encode()
        firsts[payload] = min(firsts.get(payload, 1 << 62), 1 << 62 if i is None else i)
    for i, url, html in rows:
        payload = (html or "").encode()
        row = got[i][0]
        first = firsts[payload]
        assert row["payload_bytes"] == len(payload) and row["payload_digest"] == warc.base32_sha1(payload)
        assert row["record_type"] == ("response" if first == i else "revisit")
        assert row["refers_to"] == (None if first == i else first)
        assert row["payload"] == (payload if first == i else None)
    files = list((tmp_path / "archives").glob("part-*"))
    assert len(files) > 1 and all(f.read_bytes()[:4] == warc.DICTIONARY_MAGIC for f in files)


def test_small_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "ab", "", "") for i in range(3)], PAGES)
    warc.write(pages, str(tmp_path / "a"), least_bytes=3)
    assert {r["record_type"] for r in warc.read(spark, str(tmp_path / "a")).collect()} == {"response"}


def test_no_pages(spark, tmp_path):
    warc.write(spark.createDataFrame([], PAGES), str(tmp_path / "a"))
    assert warc.read(spark, str(tmp_path / "a")).count() == 0


def test_a_dictionary_helps_and_a_reader_needs_one_frame():
    records = [warc.record(i, f"http://host/{i}", b"<html>" + hashlib.md5(b"%d" % i).hexdigest().encode() * 9, None) for i in range(500)]
    parts = list(warc.frames(records))
    assert list(warc.records_of(b"".join(parts))) == records
    assert list(warc.records_of(parts[0] + parts[77])) == [records[76]]
    assert sum(map(len, parts[1:])) < sum(len(warc.zstandard.compress(r)) for r in records)


# ---------------------------------------------------------------- nearest neighbours


def test_recall_and_ties(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 24)) * rng.uniform(0.5, 2, (400, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[7].tolist()) for i in range(30)]
    bad = [(2000, None), (2001, []), (2002, [0.0] * 24), (2003, [float("nan")] * 24), (2004, [1.0] * 3), (None, x[0].tolist()),
           (2005, [None] + [1.0] * 23), (2006, [float("inf")] * 24), (7, x[7].tolist())]
    frame = spark.createDataFrame([(*row, "k") for row in rows + bad], "vec_id bigint, embedding array<double>, key string")
    got = cross_polytope.search(frame, F.col("key") % 20 == 0, k=20).collect()
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows])
    found = {}
    for row in got:
        found.setdefault(row["query_id"], []).append(row)
    hits = 0
    queries = [i for i in ids.tolist() if i % 20 == 0]
    assert set(found) == set(queries)
    for q in queries:
        score = (vectors * vectors[ids == q][0]).sum(axis=1)
        best = [i for i in ids[np.lexsort((ids, -score))].tolist() if i != q][:20]
        mine = sorted(found[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)
        exact = dict(zip(ids.tolist(), score.tolist()))
        assert all(r["score"] == pytest.approx(exact[r["vec_id"]], abs=1e-12) for r in mine)
        hits += len({r["vec_id"] for r in mine} & set(best))
    assert hits >= 0.9 * 20 * len(queries)


def nearest(rows, query, k):
    score = {i: float(np.dot(v, dict(rows)[query])) for i, v in rows if i != query}
    return sorted(score, key=lambda i: (-score[i], i))[:k]


@pytest.mark.parametrize("size", [2, 15, 21])
def test_small_tables_give_all_candidates(spark, size):
    x = np.random.default_rng(size).normal(size=(size, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = cross_polytope.search(frame, F.lit(True), k=20).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(q, i) for q in range(size) for i in nearest(rows, q, 20)]


def test_long_vectors_do_not_hide_the_others(spark):
    x = np.random.default_rng(4).normal(size=(600, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[1:600:200] *= 1e4
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {}
    for row in cross_polytope.search(frame, F.col("key") % 20 == 0, k=20).collect():
        found.setdefault(row["query_id"], set()).add(row["vec_id"])
    queries = range(0, 600, 20)
    assert all(len(found[q]) == 20 for q in queries)
    hits = [len(found[q] & set(nearest(rows, q, 20))) for q in queries]
    assert min(hits) > 5 and sum(hits) >= 0.8 * 20 * len(hits)


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert cross_polytope.search(frame, F.col("key") % 20 == 0).count() == 0


def test_rotation_keeps_lengths():
    x = np.random.default_rng(2).normal(size=(5, 20))
    turned = cross_polytope.rotate(x, 3)
    assert turned.shape == (5, 32) and np.allclose(np.linalg.norm(turned, axis=1), np.linalg.norm(x, axis=1))


# ---------------------------------------------------------------- SentencePiece


STRANGE = ["", " ", "  ", "a ", " a", "a\nb", "a ▁b", "\x00a", "é x 😀", " \n ", "▁", "▁▁ ▁", "<s> </s>", "word " * 300, "x" * 5000, None]


@pytest.mark.parametrize("part", [1 << 21, 7])
def test_encoding_is_the_library_s(spark, docs, monkeypatch, part):
    monkeypatch.setattr(chunk_table, "PART_CHARS", part)
    chance = random.Random(part)
    texts = STRANGE + ["".join(chance.choices("ab▁  \nié中", k=chance.randint(0, 60))) for _ in range(200)]
    model = piece_model()
    library = chunk_table.load(model)
    assert chunk_table.splits_at_markers(model)
    encoded = chunk_table.encode(docs(list(enumerate(texts))), model)
    for row in chunk_table.decode(encoded, model).collect():
        ids = [*library.encode(texts[row["doc_id"]] or ""), library.eos_id()]
        assert row["ids"] == ids and row["text"] == library.decode(ids)
    assert chunk_table.encode(docs([]), model).count() == 0


def test_a_worker_holds_few_texts(spark, docs):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    texts = docs([(n, "word " * 20_000) for n in range(200)]).select("text").coalesce(1)
    found = [row["size"] for row in texts.mapInArrow(sizes, "size bigint").collect()]
    assert sum(found) >= 20_000_000 and max(found) < 5_000_000
    parts = list(chunk_table._parts([100_000] * 100))
    assert [n for start, end in parts for n in range(start, end)] == list(range(100))
    assert max(end - start for start, end in parts) * 100_000 < 1_000_000


# ---------------------------------------------------------------- mixing


def test_mix(spark, docs):
    chance = random.Random(9)
    rows = [(i, "w " * chance.randint(0, 40)) for i in range(300)] + [(None, "a b c"), (5, None), (7, "w w")]
    source = lambda n: [None, "b", "a", "a", "a", "ü", "c"][n % 7]
    frame = docs(rows, source)
    got = mixing.mix(frame).join(frame.select("doc_id", "source").distinct(), "doc_id", "left").collect()
    again = mixing.mix(frame.repartition(5)).collect()
    assert sorted(repr(r["passes"]) for r in got if r["doc_id"] not in (5, 7)) == sorted(repr(r["passes"]) for r in again if r["doc_id"] not in (5, 7))
    rows = mixing.mix(frame).collect()
    assert len(rows) == len(frame.collect())
    targets = {(r["source_size"], r["target"]) for r in rows}
    total = sum(r["size"] for r in rows)
    assert sum(t for _, t in targets) == pytest.approx(1.5 * total)
    assert all(t <= 2 * s + 1e-9 for s, t in targets)
    for size, target in targets:
        taken = sum(r["taken"] for r in rows if r["source_size"] == size)
        assert abs(taken - target) <= 1
    for r in rows:
        assert r["taken"] <= 2 * r["size"] and r["taken"] == sum(p["words"] for p in r["passes"])
        assert all(0 <= p["position"] <= 1 for p in r["passes"])


def test_schedules_are_followed(spark, docs):
    """A falling source is used early, a rising one late; demand at time 1/2 is its schedule's integral."""
    frame = docs([(i, "w " * 10) for i in range(900)], lambda n: "abc"[n % 3])
    mixed = mixing.mix(frame, share=1.0, schedules=((3.0, 1.0), (2.0, 2.0), (1.0, 3.0)))
    used = mixing.curriculum(mixed).join(frame.select("doc_id", "source"), "doc_id")
    half = {r["source"]: r["n"] for r in used.where("position < 0.5").groupBy("source").agg(F.sum("words").alias("n")).collect()}
    for name, share in (("a", 0.625), ("b", 0.5), ("c", 0.375)):
        assert half[name] == pytest.approx(share * 3000, abs=10)
    assert mixing.mix(docs([])).count() == 0


# ---------------------------------------------------------------- quality rules and licences


def test_quality_edges(spark, docs):
    rows = [(1, None), (2, ""), (3, "a b c d e " * 30), (4, "The cat sat on the mat and it was good for all."), (5, "# " * 40),
            (6, "\n".join(["the same line of words"] * 9 + ["another of it and that"])), (7, "the of and " * 40_000)]
    got = {r["doc_id"]: r for r in quality.judge(quality.measures(docs(rows))).collect()}
    assert [got[i]["n_words"] for i in range(1, 8)] == [0, 0, 150, 12, 40, 50, 120_000]
    assert got[3]["n_repeat_words"] == 150 and got[7]["n_repeat_words"] == 120_000 and got[4]["n_repeat_words"] == 0
    assert got[6]["n_dup_lines"] == 8 and got[5]["n_symbols"] == 40
    assert [i for i in got if got[i]["kept"]] == [4] and not got[4]["base_failed"]
    assert quality.judge(quality.measures(docs([]))).count() == 0


def test_a_table_of_one_rule(spark, docs):
    rule = quality.Rule("many", "n_words", low=12)
    got = {r["doc_id"]: r["kept"] for r in quality.judge(quality.measures(docs([(1, "a b c d e f g h i j"), (2, "a b c d e f g h i j k l")])), (rule,)).collect()}
    assert got == {1: False, 2: True}


def test_licenses(spark, docs):
    mit = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, f"prose here\n{mit}\nmore"), (4, mit.upper().replace(" ", " -- ")), (5, "the MIT licence is fine"),
            (6, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and\n"
                'associated documentation files (the "Software"), to deal in the Software without restriction.'),
            (7, "word"), (8, f"{mit}\nLicensed under CC BY 4.0.")]
    got = {r["doc_id"]: (r["licenses"], r["license"], r["score"]) for r in licenses.scan(docs(rows)).collect()}
    assert got[3] == (["MIT"], "MIT", 1.0) == got[4] and got[6][1] == "MIT-grant" and got[8][0][:1] == ["CC-BY-4.0"] and "MIT" in got[8][0]
    assert all(got[i] == ([], None, None) for i in (1, 2, 5, 7))
    assert licenses.scan(docs([])).count() == 0 and licenses.scan(docs([(1, "x")]), templates={}).count() == 1


def test_licenses_in_runs_of_words(spark, docs):
    prose = "one two three four five six seven eight nine ten"
    rows = [(1, f"Copyright X. Released under the MIT License. See LICENSE for details. {prose}"),
            (2, f"{prose}\nThis work is licensed under the GNU\nGeneral Public License,\nversion 3.\n{prose}"),
            (3, f"{prose} released under a licence of MIT {prose}")]
    got = {r["doc_id"]: (r["license"], r["score"]) for r in licenses.scan(docs(rows)).collect()}
    assert got == {1: ("MIT", 1.0), 2: ("GPL-3.0", 1.0), 3: (None, None)}


def test_a_reader_copies_little_of_an_archive(monkeypatch):
    """A frame's decompressor is not handed all the rest of its archive."""
    records = [warc.record(i, None, hashlib.sha256(b"%d" % i).hexdigest().encode() * 200, None) for i in range(300)]
    records.append(warc.record(300, None, "".join(map(str, range(60_000))).encode(), None))
    archive, seen = b"".join(warc.frames(records)), []
    made = warc.zstandard.ZstdDecompressor

    class Watched:
        def __init__(self, *args, **kwargs):
            self.inner = made(*args, **kwargs)

        def decompressobj(self):
            worker = self.inner.decompressobj()

            class Worker:
                eof = property(lambda _: worker.eof)
                unused_data = property(lambda _: worker.unused_data)

                def decompress(self, data):
                    seen.append(len(data))
                    return worker.decompress(data)

            return Worker()

    monkeypatch.setattr(warc.zstandard, "ZstdDecompressor", Watched)
    assert list(warc.records_of(archive)) == records
    assert max(seen) <= warc.FEED_BYTES < len(archive)
    with pytest.raises(ValueError, match="too early"):
        list(warc.records_of(archive[:-9]))
