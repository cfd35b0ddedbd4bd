"""Operator 3: near duplicates by BagMinHash signatures.

A document is the multiset of its five-word shingles (of all its words, if it has fewer). For the
weighted Jaccard coefficient the weights are discretised to unit levels, and every level of every
shingle has a Poisson process of points on the signature's registers; a register keeps its smallest
point. The levels are gathered hierarchically: the levels 2^(j-1)+1 .. 2^j of a shingle share one
process, a point of it is handed down to a random level and counts if the document has that level.
Processes yield points in ascending order and stop once they exceed the signature's largest
register. Two signatures agree in a register with exactly the probability of the multisets' overlap.

Equal word sequences become one node before anything else. Signatures are cut into bands; nodes that
agree in a band meet. In every bucket all nodes are compared with one leader, the multisets
themselves, and connected. In buckets that still hold several components every pair of unconnected
nodes is compared: in small buckets as rows, in large ones block against block inside a task, which
gives back only the links that connect. So no pair that meets in a band is missed, and the rows made
stay in proportion to the nodes in buckets. The class of a document is the smallest id of its component.

Null and empty texts have no words and no duplicates. Repeated rows and equal ids with equal words
are copies; a null id is a document like others. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import components
from platewise.llm.rolling import mix, prefixes, spans, word_bounds
from platewise.session import stage

SHINGLE = 5
SIMILARITY = 0.8
# A pair of similarity 0.8 fails to meet in all bands with probability (1 - 0.8^4)^32 < 10^-7.
BANDS, ROWS = 32, 4
# Buckets of more nodes are compared in blocks of so many nodes, others as rows.
SMALL_BUCKET = 32
BLOCK_NODES = 768
BATCH_WORDS = 200_000


def shingles(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of space-joined words, ascending, and how often each occurs."""
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = min(SHINGLE, len(starts))
    return np.unique(spans(prefixes(data), starts[: len(starts) - size + 1], ends[size - 1 :]), return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard coefficient of two multisets."""
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][at_a], b[1][at_b]).sum())
    either = int(a[1].sum() + b[1].sum()) - both
    return both / either if either else 0.0


def signatures(docs: np.ndarray, elements: np.ndarray, counts: np.ndarray, n: int, registers: int) -> np.ndarray:
    """BagMinHash signatures of n multisets given as (document, element, count) rows."""
    parts = []
    level = 0
    while True:
        base = 0 if level == 0 else 1 << (level - 1)
        held = counts > base
        if not held.any():
            break
        seeds = mix(elements[held] + np.uint64((level * 0xD1B54A32D192ED03 + 1) % (1 << 64)))
        size = max(base, 1)
        parts.append((docs[held], seeds, np.full(len(seeds), size), np.full(len(seeds), base), counts[held]))
        level += 1
    h = np.full(n * registers, np.inf)
    if not parts:
        return h.reshape(n, registers)
    doc, seed, size, base, count = (np.concatenate(column) for column in zip(*parts))
    x, step = np.zeros(len(doc)), 0
    while len(doc):
        step += 1
        draw = mix(seed + np.uint64((step * 0x9E3779B97F4A7C15) % (1 << 64)))
        x = x - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (registers * size)
        where = mix(draw ^ np.uint64(0xA0761D6478BD642F))
        register = (where % np.uint64(registers)).astype(np.int64)
        own = base + 1 + ((where >> np.uint64(20)) % size.astype(np.uint64)).astype(np.int64)
        kept = own <= count
        np.minimum.at(h, doc[kept] * registers + register[kept], x[kept])
        active = x < h.reshape(n, registers).max(axis=1)[doc]
        doc, seed, size, base, count, x = (column[active] for column in (doc, seed, size, base, count, x))
    return h.reshape(n, registers)


def band_values(h: np.ndarray) -> np.ndarray:
    """One 64-bit number for every band of every signature, different bands apart."""
    bits = h.view(np.uint64).reshape(len(h), BANDS, ROWS)
    value = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(h), 1))
    for row in range(ROWS):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, row])
    return value.view(np.int64)


def _node(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "node", "bands"]

    def emit(keys: list, texts: list[bytes]) -> pa.RecordBatch:
        bags = [shingles(text) for text in texts]
        docs = np.repeat(np.arange(len(bags)), [len(bag[0]) for bag in bags])
        elements = np.concatenate([bag[0] for bag in bags])
        values = band_values(signatures(docs, elements, np.concatenate([bag[1] for bag in bags]), len(bags), BANDS * ROWS))
        bands = [row if len(bag[0]) else None for row, bag in zip(values, bags)]
        nodes = [_node(text) if text else None for text in texts]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names
        )

    for batch in batches:
        keys, texts, size = [], [], 0
        for key, text in zip(batch.column(0), batch.column(1)):
            joined = b" ".join(text.as_py().split())
            keys.append(key)
            texts.append(joined)
            size += len(joined) // 6 + 1
            if size >= BATCH_WORDS:
                yield emit(pa.array([k.as_py() for k in keys], batch.schema.field(0).type), texts)
                keys, texts, size = [], [], 0
        if keys:
            yield emit(pa.array([k.as_py() for k in keys], batch.schema.field(0).type), texts)


def _bytes(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))


def _only_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (node, text) rows those whose text is the node's."""
    for batch in batches:
        nodes, texts = [], []
        for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            joined = b" ".join(text.split())
            if _node(joined) == node:
                nodes.append(node)
                texts.append(joined)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(texts, pa.binary())], ["node", "text"])


def _verifier(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)  # rows come sorted by b: a leader's multiset is made once
        for batch in batches:
            a, b, linked = *(column.to_pylist() for column in batch.columns[:2]), []
            for i in range(len(a)):
                if last[0] != b[i]:
                    last = (b[i], shingles(batch.column(3)[i].as_py()))
                linked.append(similarity(shingles(batch.column(2)[i].as_py()), last[1]) >= least)
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return run


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(documents, classes): (key, node) of every row, and (node, root) of every node with a near duplicate."""
    source = _bytes(docs, key, text)
    kind = source.schema["key"].dataType.simpleString()
    sketched = stage(source.mapInArrow(_sketch, f"key {kind}, node binary, bands array<bigint>"), "sketches")
    nodes = sketched.where("node IS NOT NULL").groupBy("node").agg(F.min("key").alias("key"), F.first("bands").alias("bands"))
    rows = nodes.select("node", "key", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    members = stage(rows.join(shared.select("band"), "band", "left_semi"), "members")

    wanted = members.groupBy("node").agg(F.min("key").alias("key"))
    texts = source.join(wanted, source["key"].eqNullSafe(wanted["key"])).select("node", "text")
    bags = stage(texts.mapInArrow(_only_nodes, "node binary, text binary").dropDuplicates(["node"]), "bags")

    def compare(pairs: DataFrame, label: str) -> DataFrame:
        one = bags.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        two = bags.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        full = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
        return stage(full.mapInArrow(_verifier(least), "a binary, b binary"), label)

    # a leader for each bucket, by an order that is the same in all: copies of one text meet one leader
    order = F.struct(F.xxhash64("node"), "node")
    leaders = members.groupBy("band").agg(F.min(order).alias("first")).select("band", F.col("first.node").alias("b"))
    met = members.join(leaders, "band").where("node <> b").select(F.col("node").alias("a"), "b")
    stars = compare(stage(_ordered(met), "stars"), "star-links")
    roots = _roots(members, stars, "star")

    placed = members.select("band", "node").join(roots, "node")
    mixed = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
    open_ = stage(placed.join(mixed.where("low <> high").select("band", "n"), "band"), "open")
    left, right = open_.where(F.col("n") <= SMALL_BUCKET).alias("l"), open_.alias("r")
    few = left.join(right, F.expr("l.band = r.band AND l.root < r.root"))
    links = compare(stage(_ordered(few.select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))), "few"), "few-links")
    many = _block_links(open_.where(F.col("n") > SMALL_BUCKET), bags, least)
    found = links.unionByName(many)
    # links between roots: the components of what is left are those of a small graph
    of = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    to = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    between = stage(found.join(of, "a").join(to, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), "between")
    if between.isEmpty():
        return sketched.select("key", "node"), roots
    merged = components(between, "merged").select(F.col("id").alias("root"), F.col("root").alias("top"))
    final = roots.join(merged, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return sketched.select("key", "node"), stage(final, "roots")


def _ordered(met: DataFrame) -> DataFrame:
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _roots(members: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """(node, root) of every node in a bucket."""
    nodes = members.select("node").distinct()
    joined = components(links, label).select(F.col("id").alias("node"), "root")
    return stage(nodes.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node")), f"{label}-roots")


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Common elements of every pair of two lists of sets, by products of their incidence matrices."""
    found, inverse, times = np.unique(np.concatenate([*a, *b]), return_inverse=True, return_counts=True)
    column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[inverse]
    owner = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in (*a, *b)])
    column, owner = column[column >= 0], owner[column >= 0]
    total = np.zeros((len(a), len(b)), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        some = slice(*np.searchsorted(column, (low, low + 4096)))
        held = np.zeros((len(a) + len(b), 4096), np.float32)
        held[owner[some], column[some] - low] = 1
        total += held[: len(a)] @ held[len(a) :].T
    return total


def _elements(data: bytes) -> np.ndarray:
    """A multiset as a set: an element for every shingle and number of its occurrence."""
    values, counts = shingles(data)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.where(number == 0, np.repeat(values, counts), mix(np.repeat(values, counts) + number.astype(np.uint64)))


def _block(least: float, part: int = 128):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        p, q = int(rows["p"].iloc[0]), int(rows["q"].iloc[0])
        one = rows[rows["block"] == p].reset_index(drop=True)
        two = rows[rows["block"] == q].reset_index(drop=True)
        parent: dict[bytes, bytes] = {}

        def top(x: bytes) -> bytes:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = []
        sets = {frame: [_elements(text) for text in table["text"]] for frame, table in ((1, one), (2, two))}
        for i in range(0, len(one), part):
            for j in range(i if p == q else 0, len(two), part):
                a, b = sets[1][i : i + part], sets[2][j : j + part]
                both = overlaps(a, b)
                sizes = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None, :]
                for x, y in np.argwhere(both >= least * (sizes - both) - 1e-6).tolist():
                    s, t = one["root"][i + x], two["root"][j + y]
                    u, v = top(s), top(t)
                    if u != v and both[x, y] / (sizes[x, y] - both[x, y]) >= least:
                        parent[u] = v
                        out.append((one["node"][i + x], two["node"][j + y]))
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def _block_links(open_: DataFrame, bags: DataFrame, least: float) -> DataFrame:
    """Links between components in large buckets, every block of a bucket against every other."""
    blocks = F.ceil(F.col("n") / F.lit(BLOCK_NODES)).cast("int")
    dealt = open_.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = dealt.select("band", "node", "root", "block", other).select(
        "band", "node", "root", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")
    )
    full = paired.join(bags, "node").groupBy("band", "p", "q").applyInPandas(_block(least), "a binary, b binary")
    return stage(full.distinct(), "block-links")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(key, class_id, class_size): one row per document; the class is the smallest id of its group."""
    rows, roots = link(docs, key, text, least)
    by_node = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("key").alias("low"), F.count("*").alias("n"))
    rooted = by_node.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = rooted.groupBy("root").agg(F.min("low").alias("class_id"), F.sum("n").alias("class_size"))
    named = stage(rooted.select("node", "root").join(groups, "root").drop("root"), "classes")
    full = rows.join(named, "node", "left")
    alone = F.col("class_size").isNull()
    return full.select(
        F.col("key").alias(key),
        F.when(alone, F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
    )
