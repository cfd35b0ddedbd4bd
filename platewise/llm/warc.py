"""Operator 5: WARC archives compressed record by record under a dictionary of their own.

Every archive starts with a skippable frame that holds a Zstandard dictionary built from the archive's
own records; every record after it is a frame of its own, so a reader that knows a record's offset
needs the dictionary and that frame only. Spark's text sink writes the files, one frame a row: the line
separator is an empty skippable frame, so the file is a valid Zstandard stream, on any store that
Spark can write. Archives are as large as ``archive_bytes`` of payload, so a task holds one at a time.

The payload is the page's text in UTF-8, null is empty. Of pages with equal payloads the one with the
smallest id has the payload in a response record, the others are revisit records without it that name
that id. A page smaller than ``least_bytes`` is always a response. Repeated rows that share the smallest
id are all responses; a null id comes after all others and is written as an empty id. A URL loses what a
header line cannot hold, percent-encoded; a null URL has no header. Extra columns are not read. An
empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the formats: magic numbers of skippable frames (little endian), the second of which
# the dictionary's frame has, and a skippable frame without content.
FRAME_MAGIC = bytes.fromhex("28b52ffd")
DICTIONARY_MAGIC = bytes.fromhex("5d2a4d18")
EMPTY_FRAME = bytes.fromhex("502a4d1800000000")

ARCHIVE_BYTES = 16 << 20  # payload of one archive, before compression
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20  # of an archive's records, what the dictionary is built from
LEVEL = 3
FEED_BYTES = 4 << 10  # of an archive, what a reader looks at together
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---------------------------------------------------------------- records


def identify(pages: DataFrame, key: str, url: str, html: str, least_bytes: int, archives: int) -> DataFrame:
    """(key, url, payload, refers_to) dealt out over the archives; refers_to is null for responses.

    Equal payloads meet by SHA-256. Only digests and ids are grouped, combined before the shuffle, and
    joined; the payloads are shuffled once, by id and digest, to meet their row there.
    """
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("bigint").alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("same", F.unhex(F.sha2("payload", 256)))
    # pages without an id are told apart by their URL only to spread them
    spread = F.when(F.col("key").isNull(), F.col("url"))
    place = F.unhex(F.md5(F.concat_ws(" ", F.hex("same"), F.col("key").cast("string"), spread)))
    rows = rows.withColumn("place", place)
    narrow = rows.where(F.octet_length("payload") >= least_bytes).select("key", "same", "place")
    first = narrow.groupBy("same").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisits = narrow.join(first, "same").where("first IS NOT NULL AND NOT key <=> first").select("place", "first").distinct()
    met = rows.repartition(archives, "place").join(revisits.repartition(archives, "place"), "place", "left")
    return met.select("key", "url", "payload", F.col("first").alias("refers_to"))


def record(key: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: headers, blank line, HTTP headers, blank line, payload, two line ends."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if key is None else key}>",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe='!#$%&()*+,/:;=?@[]~')}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple:
    """(key, url, type, refers_to, payload bytes, payload digest, payload) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length is not what its header says")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError("a payload is not what its record says")

    def page(value: str) -> int | None:
        number = value.removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    refers = headers.get("WARC-Refers-To")
    return (
        page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind, page(refers) if refers else None,
        size, digest, payload if kind == "response" else None,
    )


# ---------------------------------------------------------------- archives


def dictionary_frame(dictionary: bytes) -> bytes:
    return DICTIONARY_MAGIC + len(dictionary).to_bytes(4, "little") + dictionary


def build_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from the first records, evenly spaced if there are many; empty if there are too few."""
    total, step = sum(map(len, records)), 1
    step = max(1, -(-total // SAMPLE_BYTES))
    sample = [data[:16384] for data in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=512, d=8).as_bytes()
    except zstandard.ZstdError:  # too few or too short records
        return b""


def frames(records: list[bytes]) -> Iterator[bytes]:
    """The dictionary's frame, then a frame for every record."""
    dictionary = build_dictionary(records)
    yield dictionary_frame(dictionary)
    own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=True)
    for data in records:
        yield compressor.compress(data)


def records_of(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, frame by frame."""
    place, whole, decompressor = 0, memoryview(archive), zstandard.ZstdDecompressor()
    while place < len(archive):
        magic = archive[place : place + 4]
        if magic == FRAME_MAGIC:
            # fed in pieces: what follows a frame in the last one is copied, not the rest of the archive
            worker, record_ = decompressor.decompressobj(), []
            while not worker.eof and place < len(archive):
                record_.append(worker.decompress(whole[place : place + FEED_BYTES]))
                place += FEED_BYTES
            if not worker.eof:
                raise ValueError("a frame of an archive ends too early")
            place = min(place, len(archive)) - len(worker.unused_data)
            yield b"".join(record_)
        else:
            size = int.from_bytes(archive[place + 4 : place + 8], "little")
            if magic == DICTIONARY_MAGIC and size:
                own = zstandard.ZstdCompressionDict(archive[place + 8 : place + 8 + size])
                decompressor = zstandard.ZstdDecompressor(dict_data=own)
            place += 8 + size


def write(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write every page as a record into the archives of the folder ``path``."""
    total = pages.agg(F.sum(F.octet_length(html)), F.count("*")).first()
    count = max(1, -(-((total[0] or 0) + 512 * total[1]) // archive_bytes))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = [record(*row) for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns))]
        part: list[bytes] = []
        for frame in frames(records) if records else ():
            part.append(frame)
            if len(part) == 500:
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary())], ["frame"])
                part = []
        if part:
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary())], ["frame"])

    identified = identify(pages, key, url, html, least_bytes, int(count))
    out = identified.mapInArrow(archive, "frame binary").select(F.col("frame").cast("string").alias("value"))
    out.write.option("lineSep", EMPTY_FRAME.decode("ascii")).option("compression", "none").text(path)


READ_SCHEMA = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, payload binary"
)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in ``path``; revisits have no payload."""
    names = [part.split()[0] for part in READ_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for content in batch.column(0):
                for data in records_of(content.as_py()):
                    rows.append(parse(data))
                    if len(rows) == 500:
                        yield emit(rows)
                        rows = []
        if rows:
            yield emit(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(unpack, READ_SCHEMA)
