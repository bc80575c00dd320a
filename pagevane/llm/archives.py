"""Web archives compressed with a dictionary of their own, written and read back by Spark.

Every archive is one output file, a row of Zstandard frames: first a skippable frame that holds the
archive's dictionary (itself compressed), then one frame for each WARC record, so that a record can be read
alone. The dictionary is built in the writing task from the archive's own records, of which at most
``SAMPLE_BYTES`` are held for it; it changes sizes, never contents. Too little to build one from: no dictionary.

Tasks hand frames to Spark's own text writer, whose line separator is an empty skippable frame. So archives
reach any file system that Spark writes to, by its commit protocol: a task that is lost leaves nothing behind.

Rules: a null html is an empty payload. Payloads of ``floor`` bytes or more that are equal (by SHA-1) are
archived once, with the largest page_id; the other pages revisit it, without payload. Pages that share that
largest id are all responses; a null id is smaller than any other, and where all are null all are responses.
A null url gives no target URI; control characters and spaces in urls are percent-encoded. Every row gives one record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _work_folder, written

FLOOR = 1000
ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 112 << 10
SAMPLE_BYTES = 4 << 20
LEVEL = 3

# Magic numbers of Zstandard frames and of the dictionary's skippable frame, and the profile of
# a revisit (WARC 1.1, and its Zstandard profile).
FRAME = 0xFD2FB528
SKIPPABLE = 0x184D2A50
DICTIONARY = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# An empty skippable frame, in ASCII.
SEPARATOR = "P*M\x18\0\0\0\0"
BUCKET_POWER = 0.6
RECORD = "page_id long, url string, html binary, digest string, refers_to long"
READ = (
    "archive string, place long, record_id string, record_type string, page_id long, url string, "
    "payload_bytes long, payload_digest string, refers_to long"
)


# --- which pages are archived whole ---------------------------------------------------------


def planned(pages: DataFrame, floor: int = FLOOR) -> tuple[DataFrame, int]:
    """``pages`` with ``digest`` and ``refers_to``, dealt over archives; and the number of these.

    Copies meet in buckets of their digest: as many buckets as a digest held by all rows would need. Only
    what a bucket says about its copies is gathered by digest, and sent back to the buckets.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("html"))
    buckets = max(1, int(rows.count() ** BUCKET_POWER))
    bucket = F.pmod(F.xxhash64("page_id", "url"), F.lit(buckets)).alias("bucket")
    rows = rows.select("*", F.sha1("html").alias("digest"), bucket)
    light = rows.select("digest", "bucket", "page_id", F.octet_length("html").cast("long").alias("size"))
    held = light.groupBy("digest", "bucket").agg(
        F.max("page_id").alias("last"), F.count("*").alias("n"), F.sum("size").alias("size")
    )
    held = written(held)
    total = held.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    archives = max(1, -(-total // ARCHIVE_BYTES))
    shared = held.filter(F.col("size") >= F.col("n") * floor).groupBy("digest")
    shared = shared.agg(F.max("last").alias("response"), F.sum("n").alias("copies")).filter("copies > 1")
    told = held.select("digest", "bucket").join(shared.select("digest", "response"), "digest")
    dealt = rows.repartition(archives, "digest", "bucket")
    joined = dealt.join(told.repartition(archives, "digest", "bucket"), ["digest", "bucket"], "left")
    own = F.col("page_id").isNotNull() & (F.col("page_id") == F.col("response"))
    refers = F.when(F.col("response").isNotNull() & ~own, F.col("response"))
    return joined.select("page_id", "url", "html", "digest", refers.alias("refers_to")), archives


# --- records ----------------------------------------------------------------------------------


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id}:{digest}'.encode()).hexdigest())}>"


def _uri(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str
) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page_id, digest),
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else _uri(url),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "WARC-Profile": PROFILE if revisit else None,
        "WARC-Refers-To": _record_id(refers_to, digest) if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Page-ID": page_id,
        "Refers-To-Page-ID": refers_to,
        "Content-Length": len(block),
    }
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items() if value is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """What a record says; a response's digest is taken from its payload anew."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [line for line in http.decode().split("\r\n") if line.startswith("Content-Length: ")]
    size = int(sizes[0].split(": ")[1])
    if fields["WARC-Type"] == "response":
        if len(payload) != size:
            raise ValueError(f"{fields['WARC-Record-ID']}: {len(payload)} bytes of {size}")
        digest = hashlib.sha1(payload).hexdigest()
    else:
        payload, digest = None, base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    number = {k: int(fields[k]) if k in fields else None for k in ("Page-ID", "Refers-To-Page-ID")}
    return {
        "record_id": fields["WARC-Record-ID"],
        "record_type": fields["WARC-Type"],
        "page_id": number["Page-ID"],
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": number["Refers-To-Page-ID"],
        "payload": payload,
    }


# --- frames -----------------------------------------------------------------------------------


def dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of at most ``size`` bytes and a tenth of the samples, or none if they are too few."""
    size = min(size, sum(map(len, samples)) // 10)
    if size < 1024:
        return None
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8)
    except zstandard.ZstdError:
        return None


def _frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """The frames of one archive: its dictionary, then its records."""
    held, size = [], 0
    for data in records:
        held.append(data)
        size += len(data)
        if size >= SAMPLE_BYTES:
            break
    if not held:
        return
    trained = dictionary(held)
    if trained is None:
        compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
    else:
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(trained.as_bytes())
        yield struct.pack("<II", DICTIONARY, len(packed)) + packed
        compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, dict_data=trained)
    for some in (held, records):
        for data in some:
            yield compressor.compress(data)


def _batches(frames: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for frame in frames:
        held.append(frame)
        size += len(frame)
        if size >= 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["frame"])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["frame"])


def unpacked(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    view, at, step = memoryview(archive), 0, 1 << 16
    reader = zstandard.ZstdDecompressor()
    while at < len(view):
        (magic,) = struct.unpack_from("<I", view, at)
        if magic & 0xFFFFFFF0 == SKIPPABLE:
            (size,) = struct.unpack_from("<I", view, at + 4)
            if at + 8 + size > len(view):
                raise ValueError(f"cut off at byte {at}")
            if magic == DICTIONARY:
                body = bytes(view[at + 8 : at + 8 + size])
                if struct.unpack_from("<I", body)[0] == FRAME:
                    body = zstandard.ZstdDecompressor().decompress(body)
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            at += 8 + size
            continue
        one, parts = reader.decompressobj(), []
        while not one.eof:
            if at >= len(view):
                raise ValueError("cut off inside a record")
            fed = view[at : at + step]
            parts.append(one.decompress(fed))
            at += len(fed) - len(one.unused_data)
        yield b"".join(parts)


# --- archives ---------------------------------------------------------------------------------


def write_archives(pages: DataFrame, folder: str, floor: int = FLOOR, date: str | None = None) -> None:
    """One record for each row of ``pages`` (``page_id, url, html``), in archives of about ``ARCHIVE_BYTES``."""
    rows, _ = planned(pages, floor)
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("page_id", "url", "html", "digest", "refers_to")]
            for row in zip(*columns):
                yield record(*row, date)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_frames(records(batches)))

    frames = rows.mapInArrow(write, "frame binary")
    frames.select(F.col("frame").cast("string")).write.option("lineSep", SEPARATOR).text(folder)


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """All records of the archives in a folder, where they stand, and (unless told otherwise) their payloads."""
    schema = READ + (", payload binary" if payload else "")
    names = [part.split()[0] for part in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                held, size = [], 0
                for place, data in enumerate(unpacked(content.as_buffer())):
                    row = {"archive": path, "place": place, **parsed(data)}
                    if not payload:
                        row.pop("payload")
                    held.append(row)
                    size += 500 + payload * len(data)
                    if size >= 4 << 20:
                        yield _rows(held, names)
                        held, size = [], 0
                if held:
                    yield _rows(held, names)

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(read, schema)


def _rows(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    numbers = {"place", "page_id", "payload_bytes", "refers_to"}
    kinds = {n: pa.int64() if n in numbers else pa.binary() if n == "payload" else pa.string() for n in names}
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[n]) for n in names], names)


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes ``pages`` to archives in a new folder, reads them back, and tells of each page how it was kept.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``.
    """
    spark = pages.sparkSession
    folder = folder or f"{_work_folder(spark)}/{uuid.uuid4().hex}"
    write_archives(pages, folder)
    found = read_archives(spark, folder, payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH kept AS (
    SELECT page_id, coalesce(html, '') AS html FROM pages
), sized AS (
    SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest FROM kept
), known AS (
    SELECT *,
        CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS response
    FROM sized
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
    CASE WHEN response IS NOT NULL AND page_id IS DISTINCT FROM response THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM known
"""
