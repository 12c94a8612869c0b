"""WARC archives of individually compressed records under a dictionary in a leading skippable frame.

Spark's text sink writes the files: each row is one frame, and the line separator is an empty skippable
frame, which every Zstandard reader passes over. So commits, retries and any file system are Spark's matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import slices
from tideline.session import new_path, stage

# Fixed values of the formats.
EMPTY_FRAME = "P*M\x18\0\0\0\0"
DICTIONARY_MAGIC = (0x184D2A5D).to_bytes(4, "little")
SKIPPABLE = re.compile(rb"[\x50-\x5f]\x2a\x4d\x18", re.S)
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:x-page:"

LEAST_BYTES = 100
DICTIONARY_BYTES = 16 << 10
SAMPLE_BYTES = 1 << 20
LEVEL = 3
#: Payloads that more than one in so many of the repeated records hold are fewer than that, and broadcast.
HOT_SHARE = 1_000


def marked(pages: DataFrame) -> DataFrame:
    """``(page_id, url, payload, digest, first)``: ``first`` is the page that holds an equal payload, null for responses.

    Payloads met very often are joined by broadcast, so no task gathers the copies of a common page.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.length("payload") >= LEAST_BYTES)
    again = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    again = stage(again.where("n > 1"), "payloads")
    total = again.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(again.where(F.col("n") * HOT_SHARE > total).select("digest", "first"))
    rest = again.where(F.col("n") * HOT_SHARE <= total).select("digest", "first")
    first = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    joined = rows.join(hot, "digest").unionByName(rows.join(hot.select("digest"), "digest", "left_anti").join(rest, "digest", "left"))
    return joined.select("page_id", "url", "payload", "digest", first.alias("first"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One uncompressed record. Line breaks in a URL are percent-encoded."""
    revisit = first is not None
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{RECORD_ID}{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {uri}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <{RECORD_ID}{first}>"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else len(payload))}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + (b"" if revisit else payload) + b"\r\n\r\n"


def frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """The frames of one archive: its dictionary, trained on its first records up to ``SAMPLE_BYTES``, then each record."""
    first, size = [], 0
    for one in records:
        first.append(one)
        size += len(one)
        if size >= SAMPLE_BYTES:
            break
    if not first:
        return
    dictionary = None
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, [x[:SAMPLE_BYTES] for x in first])
    except zstandard.ZstdError:
        pass  # too few or too small records to learn from: an archive without dictionary
    if dictionary is not None:
        raw = dictionary.as_bytes()
        yield DICTIONARY_MAGIC + len(raw).to_bytes(4, "little") + raw
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x-info:0>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    yield packer.compress(info)
    for one in first:
        yield packer.compress(one)
    for one in records:
        yield packer.compress(one)


def write_archives(pages: DataFrame, path: str) -> None:
    """One archive file per task under ``path``; every row of ``pages`` becomes one record.

    Of records with equal payloads of at least ``LEAST_BYTES`` bytes the smallest page_id is the response and
    the others revisit it (all rows of that smallest id are responses; a null id revisits it, too; null ids
    alone are responses). A null html is an empty payload, a null url an empty target.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in slices(batches, 500):
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    yield record(*row)

        held, size = [], 0
        for frame in frames(records()):
            held.append(frame)
            size += len(frame)
            if size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["frame"])
                held, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["frame"])

    packed = marked(pages).mapInArrow(run, "frame binary")
    packed.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME).text(path)


def unpacked(data: bytes) -> Iterator[bytes]:
    """The records of one archive, frame by frame."""
    view, at, reader = memoryview(data), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        if SKIPPABLE.match(view[at : at + 4]):
            size = int.from_bytes(view[at + 4 : at + 8], "little")
            if view[at : at + 4] == DICTIONARY_MAGIC:
                known = zstandard.ZstdCompressionDict(view[at + 8 : at + 8 + size])
                reader = zstandard.ZstdDecompressor(dict_data=known)
            at += 8 + size
            continue
        start = at
        at += zstandard.frame_header_size(view[at:])
        last = False
        while not last:
            head = int.from_bytes(view[at : at + 3], "little")
            last, kind, size = bool(head & 1), head >> 1 & 3, head >> 3
            at += 3 + (1 if kind == 1 else size)
        if zstandard.get_frame_parameters(view[start : start + 18]).has_checksum:
            at += 4
        yield reader.decompress(view[start:at])


def _id(value: bytes | None) -> int | None:
    text = (value or b"").strip(b"<> ").removeprefix(RECORD_ID.encode())
    return int(text) if text else None


def parsed(data: bytes) -> tuple | None:
    """``(page_id, url, type, refers_to, digest, payload size, payload)`` of one record; None for other types."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:] if b": " in line)
    kind = fields[b"WARC-Type"].decode()
    if kind not in ("response", "revisit"):
        return None
    block = rest[: int(fields[b"Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha256:").decode()
    url = fields.get(b"WARC-Target-URI", b"").decode()
    if kind == "response":
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"damaged record of page {fields[b'WARC-Record-ID']!r}")
        return _id(fields[b"WARC-Record-ID"]), url, kind, None, digest, size, payload
    return _id(fields[b"WARC-Record-ID"]), url, kind, _id(fields[b"WARC-Refers-To"]), digest, size, None


RECORD = [
    ("page_id", "long", pa.int64()), ("url", "string", pa.string()), ("record_type", "string", pa.string()),
    ("refers_to", "long", pa.int64()), ("payload_digest", "string", pa.string()),
    ("payload_bytes", "long", pa.int64()), ("payload", "binary", pa.binary()),
]


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All page records under ``path``; the payload of a revisit is null, every other one is checked by its digest."""
    made = RECORD if with_payload else RECORD[:-1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0):
                rows: list[tuple] = []
                size = 0
                for data in unpacked(file.as_buffer()):
                    row = parsed(data)
                    if row is not None:
                        rows.append(row[: len(made)])
                        size += len(data)
                    if size > 1 << 24:
                        yield _rows(rows, made)
                        rows, size = [], 0
                yield _rows(rows, made)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, ", ".join(f"{n} {k}" for n, k, _ in made))


def _rows(rows: list[tuple], made: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(made)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, (_, _, k) in zip(columns, made)], names=[n for n, _, _ in made])


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read all records back, without payloads."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path, with_payload=False)
