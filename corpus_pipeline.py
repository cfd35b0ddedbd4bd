"""The corpus pipeline: documents through five operators, each stage written and read again.

Every stage works on all that its predecessor kept. All but the last return the columns of documents;
``n_chars`` follows the text. Null and empty texts pass every stage: they are not toxic, have no
duplicates and lose no bytes; the mix takes no words of them, so it leaves them out. Repeated rows of
one document are copies, of which one stays. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from platewise.llm import bagminhash, chunk_table, mixing, suffix_dedup, toxicity
from platewise.llm.common import table, words
from platewise.llm.queries import piece_model, toxicity_chain
from platewise.session import configure, stage

# Passages of over 50 words that stand in several places are cut, as are repeats of the operator's 400 bytes.
PASSAGE_WORDS = 51
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is under the threshold."""
    configure(spark)
    chain = toxicity_chain(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    scored = chain.score(docs.select("text", F.struct(*COLUMNS).alias("row")), "row")
    return scored.where(F.col("p_toxic") < toxicity.THRESHOLD).select("row.*")


def _row_key():
    """An id for a row: the document's, null after all others, and a fingerprint of the text."""
    return F.struct(
        F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("print")
    )


def _has_words():
    return F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, that with the smallest id; of equal rows one. Texts without words all stay."""
    configure(spark)
    rows = docs.where(_has_words()).select(*COLUMNS, _row_key().alias("row"))
    found = bagminhash.classes(rows, "row").where("class_size > 1 AND row <> class_id")
    gone = found.select("row.id", "row.print").distinct()
    rows = rows.select(*COLUMNS, "row.id", "row.print").join(gone, ["id", "print"], "left_anti")
    first = F.row_number().over(Window.partitionBy("id", "print").orderBy("lang", "source"))
    kept = rows.withColumn("place", first).where("place = 1").select(*COLUMNS)
    return kept.unionByName(docs.where(~_has_words()).select(*COLUMNS))


# Characters of more than one byte in UTF-8, every byte as a character of its own; and a byte of none of them.
_WHOLE_OR_STRAY = "([\u00C2-\u00DF][\u0080-\u00BF]|[\u00E0-\u00EF][\u0080-\u00BF]{2}|[\u00F0-\u00F4][\u0080-\u00BF]{3})|[\u0080-\u00FF]"


def _whole_characters(kept):
    """Bytes as text, without those that are left of a character that a span cut."""
    single = F.regexp_replace(F.decode(kept, "ISO-8859-1"), _WHOLE_OR_STRAY, "$1")
    return F.encode(single, "ISO-8859-1").cast("string")


def drop_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages and byte strings. Of a character that a span cuts nothing stays."""
    configure(spark)
    carry = ["whole", "lang", "source", "n_chars"]
    cut = suffix_dedup.dedup(docs.withColumn("whole", F.col("text")), carry=carry, words=PASSAGE_WORDS)
    some = F.col("n_removed") > 0
    text = F.when(some, _whole_characters(F.col("kept"))).otherwise(F.col("whole"))
    cut = cut.select("doc_id", text.alias("text"), "lang", "source", "n_chars", some.alias("some"))
    size = F.when(F.col("some"), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", size).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every use of a document, sorted by training position; a partial use keeps its first words."""
    configure(spark)
    rows = docs.select(*COLUMNS, _row_key().alias("row"))
    mixed = mixing.mix(rows, key="row").where("taken > 0").select("row.id", "row.print", "size", "passes")
    mixed = mixed.dropDuplicates(["id", "print"])
    used = rows.select(*COLUMNS, "row.id", "row.print").join(mixed, ["id", "print"])
    used = used.select("*", F.explode("passes").alias("use"))
    part = F.col("use.words") < F.col("size")
    text = F.when(part, F.array_join(F.slice(words(F.col("text")), 1, F.col("use.words").cast("int")), " "))
    used = used.select("doc_id", F.coalesce(text, "text").alias("text"), "lang", "source", "n_chars", part.alias("part"), "use")
    size = F.when(F.col("part"), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    placed = used.withColumn("n_chars", size).repartitionByRange("use.position", "doc_id")
    return placed.sortWithinPartitions("use.position", "doc_id").select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_chars, ids, text): ids of every text, and the text they decode to."""
    configure(spark)
    model = piece_model()
    others = [name for name in COLUMNS if name != "text"]
    encoded = chunk_table.encode(docs.select("text", F.struct(*others).alias("row")), model, "row")
    return chunk_table.decode(encoded, model, "row").select("row.*", "ids", "text")


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("repeated-bytes", drop_repeated_bytes),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

# No SQL can express a trained classifier or a tokenizer; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over the whole ``documents`` table, in order."""
    configure(spark)
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
