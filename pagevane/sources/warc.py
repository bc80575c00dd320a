"""Crawl archives (WARC, gzipped or plain) as rows.

One archive is one split: a gzip stream has no entry points, and crawls come in
many archives of similar size. Records are streamed, never held as a whole file.
"""

from __future__ import annotations

import glob
import io
import re
import time
import urllib.error
import urllib.request
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition

ARCHIVE_SCHEMA = (
    "path string, offset bigint, rec_type string, url string, html string, error string"
)
ARROW_SCHEMA = pa.schema(
    [
        ("path", pa.string()),
        ("offset", pa.int64()),
        ("rec_type", pa.string()),
        ("url", pa.string()),
        ("html", pa.string()),
        ("error", pa.string()),
    ]
)
# What reading an archive took, in seconds: to connect and fetch, to decompress, and all the rest until its
# last records were taken, which includes what the task does with them as they come.
TIMES_SCHEMA = (
    "struct<download_time: double, load_time: double, processing_time: double, records: bigint>"
)
ARROW_TIMED = ARROW_SCHEMA.append(
    pa.field(
        "times",
        pa.struct(
            [(f"{n}_time", pa.float64()) for n in ("download", "load", "processing")]
            + [("records", pa.int64())]
        ),
    )
)
BATCH_BYTES = 8 << 20
SKIP_BYTES = 1 << 20
READ_BYTES = 1 << 18
# Of a connection that says nothing: the task fails then, and is tried again.
TIMEOUT_SECONDS = 60


class _Clock:
    """Where the time of one archive goes."""

    def __init__(self):
        self.started = time.monotonic()
        self.download = self.load = 0.0

    def times(self, records: int) -> dict:
        rest = time.monotonic() - self.started - self.download - self.load
        return {
            "download_time": self.download,
            "load_time": self.load,
            "processing_time": rest,
            "records": records,
        }


class _Fetched(io.RawIOBase):
    """Bytes of a file as it is, with the time that they take to come."""

    def __init__(self, raw, clock: _Clock):
        self.raw = raw
        self.clock = clock

    def readable(self) -> bool:
        return True

    def close(self) -> None:
        self.raw.close()
        super().close()

    def readinto(self, target) -> int:
        started = time.monotonic()
        data = self.raw.read(len(target))
        self.clock.download += time.monotonic() - started
        target[: len(data)] = data
        return len(data)


class _GzipMembers(io.RawIOBase):
    """Decompressed bytes of a file of gzip members, one member per record.

    Hands on each piece as soon as it is decompressed, so that the records before
    a damaged or missing piece are read in full.
    """

    def __init__(self, raw, clock: _Clock):
        self.raw = raw
        self.clock = clock
        self.packed = b""
        self.plain = memoryview(b"")
        self.member = None

    def readable(self) -> bool:
        return True

    def close(self) -> None:
        self.raw.close()
        super().close()

    def readinto(self, target) -> int:
        while not self.plain and self._advance():
            pass
        n = min(len(target), len(self.plain))
        target[:n] = self.plain[:n]
        self.plain = self.plain[n:]
        return n

    def _advance(self) -> bool:
        """Decompress one more piece; False at the end of the file."""
        self.packed = self.packed or self.raw.read(READ_BYTES)
        if not self.packed:
            if self.member is not None:
                raise EOFError("the last gzip member is cut off")
            return False
        if self.member is None:
            self.member = zlib.decompressobj(zlib.MAX_WBITS | 16)
        started = time.monotonic()
        self.plain = memoryview(self.member.decompress(self.packed))
        self.clock.load += time.monotonic() - started
        self.packed = self.member.unused_data
        if self.member.eof:
            self.member = None
        return True


def _open(path: str):
    """Bytes of an archive, as they are, on a local path, object store, HDFS or HTTP."""
    if path.startswith(("http://", "https://")):
        return urllib.request.urlopen(path, timeout=TIMEOUT_SECONDS)
    if "://" in path or path.startswith("file:"):
        # Spark's names of the object store, which Arrow knows by another one.
        system, name = fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))
        return system.open_input_stream(name, compression=None)
    return open(path, "rb", buffering=0)


def _unpacked(path: str, clock: _Clock) -> io.BufferedReader:
    """Records of an archive as one byte stream, decompressed if need be."""
    started = time.monotonic()
    raw = _open(path)
    clock.download += time.monotonic() - started
    stream = io.BufferedReader(_Fetched(raw, clock), SKIP_BYTES)
    if stream.peek(2)[:2] == b"\x1f\x8b":
        return io.BufferedReader(_GzipMembers(stream, clock), SKIP_BYTES)
    return stream


def _header_lines(stream) -> tuple[dict[str, str], int]:
    """Header block up to the blank line: lower-cased names, and bytes read."""
    headers: dict[str, str] = {}
    name, size = None, 0
    while True:
        line = stream.readline()
        size += len(line)
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not text:
            return headers, size
        if text[0] in " \t" and name:
            headers[name] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        name = name.strip().lower()
        headers[name] = value.strip()


def _unchunk(body: bytes) -> bytes:
    out, stream = [], io.BytesIO(body)
    while True:
        try:
            size = int(stream.readline().split(b";")[0].strip() or b"0", 16)
        except ValueError:
            return body
        if size == 0:
            return b"".join(out)
        out.append(stream.read(size))
        stream.readline()


def _http_body(block: bytes) -> bytes:
    """Body of an HTTP message, transfer and content encoding undone."""
    stream = io.BytesIO(block)
    if not stream.readline().startswith(b"HTTP/"):
        return block
    headers, _ = _header_lines(stream)
    body = stream.read()
    if "chunked" in headers.get("transfer-encoding", "").lower():
        body = _unchunk(body)
    for encoding in reversed(headers.get("content-encoding", "").lower().split(",")):
        body = _decoded(body, encoding.strip())
    return body


def _decoded(body: bytes, encoding: str) -> bytes:
    """``body`` with one content encoding undone; ``ValueError`` for one that isn't known."""
    if encoding in ("", "identity") or not body:
        return body
    if encoding in ("gzip", "x-gzip"):
        out = []
        # A body may hold several members.
        while body.startswith(b"\x1f\x8b"):
            member = zlib.decompressobj(zlib.MAX_WBITS | 16)
            out.append(member.decompress(body))
            body = member.unused_data
        # Archives often hold bodies that are decoded already.
        return b"".join(out) if out else body
    if encoding == "deflate":
        for bits in (zlib.MAX_WBITS, -zlib.MAX_WBITS):
            try:
                return zlib.decompressobj(bits).decompress(body)
            except zlib.error:
                continue
        return body
    raise ValueError(f"content encoding {encoding}")


def _records(
    stream, rec_types: set[str] | None
) -> Iterator[tuple[int, str, str | None, str | None, str | None]]:
    """(offset, type, url, text, error) of each record; undecodable bytes are left out."""
    at = 0
    while line := stream.readline():
        start, at = at, at + len(line)
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record header at {start}")
        headers, size = _header_lines(stream)
        length = int(headers["content-length"])
        at += size + length
        kind = headers.get("warc-type", "")
        if rec_types is not None and kind not in rec_types:
            left = length
            while left and (piece := stream.read(min(left, SKIP_BYTES))):
                left -= len(piece)
            continue
        block = stream.read(length)
        if len(block) < length:
            raise EOFError(f"record at {start} is cut off")
        url, error = headers.get("warc-target-uri"), None
        if "application/http" in headers.get("content-type", ""):
            try:
                block = _http_body(block)
            except (ValueError, zlib.error) as problem:
                # One body that can't be decoded doesn't cost the records after it.
                error = f"{type(problem).__name__}: {problem}"
        yield start, kind, url, None if error else block.decode("utf-8", "ignore"), error


def _is_gone(problem: OSError) -> bool:
    """Whether an archive doesn't exist, rather than being out of reach."""
    if isinstance(problem, urllib.error.HTTPError):
        return problem.code in (404, 410)
    return isinstance(problem, (FileNotFoundError, IsADirectoryError, NotADirectoryError))


UNREACHABLE = "out of reach"


def archive_batches(
    path: str, rec_types: set[str] | None, permissive: bool, timed: bool = False, report: bool = False
) -> Iterator[pa.RecordBatch]:
    """Records of one archive in Arrow batches of bounded size; ``timed`` adds a last row with its times.

    ``report`` makes an archive out of reach one row, whose error begins with ``UNREACHABLE``. That is done
    as long as no record has left the task; later the task fails, as it does without ``report``.
    """
    schema = ARROW_TIMED if timed else ARROW_SCHEMA
    rows: list[tuple] = []
    size = records = 0
    begun = False
    clock = _Clock()
    try:
        with _unpacked(path, clock) as stream:
            for offset, kind, url, text, error in _records(stream, rec_types):
                if error and not permissive:
                    raise ValueError(error)
                rows.append((path, offset, kind, url, text, error, None))
                records += 1
                size += len(text or "")
                if size >= BATCH_BYTES:
                    begun = True
                    yield _batch(rows, schema)
                    rows, size = [], 0
    except (OSError, EOFError, ValueError, KeyError, zlib.error) as problem:
        # A network or disk that fails now may work on the next try: the task fails, and
        # Spark runs it again. What stays wrong however often it is read is set aside.
        away = isinstance(problem, OSError) and not _is_gone(problem)
        if not permissive or (away and (begun or not report)):
            raise
        if away:
            yield _batch([(path, None, None, None, None, f"{UNREACHABLE}: {problem}", None)], schema)
            return
        rows.append((path, None, None, None, None, f"{type(problem).__name__}: {problem}", None))
    if rows:
        yield _batch(rows, schema)
    if timed:
        yield _batch([(path, None, None, None, None, None, clock.times(records))], schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


class _Archive(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _WarcReader(DataSourceReader):
    def __init__(self, path: str, permissive: bool):
        self.path = path
        self.permissive = permissive
        self.rec_types: set[str] | None = None

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("rec_type",) and not self.permissive:
                wanted = {f.value}
                self.rec_types = wanted if self.rec_types is None else self.rec_types & wanted
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [_Archive(p) for p in _list_archives(self.path)]

    def read(self, partition: _Archive) -> Iterator[pa.RecordBatch]:
        yield from archive_batches(partition.path, self.rec_types, self.permissive)


def _list_archives(path: str) -> list[str]:
    if "://" in path or path.startswith("file:"):
        system, name = fs.FileSystem.from_uri(path)
        info = system.get_file_info(name)
        if info.type != fs.FileType.Directory:
            return [path]
        scheme = path[: path.index(name)] if name in path else ""
        found = system.get_file_info(fs.FileSelector(name, recursive=True))
        return sorted(scheme + i.path for i in found if i.type == fs.FileType.File)
    if fs.LocalFileSystem().get_file_info(path).type == fs.FileType.Directory:
        path = path.rstrip("/") + "/*"
    return sorted(glob.glob(path))


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)``: a file, directory or local glob.

    Option ``mode``: ``FAILFAST`` (default) fails the task on a broken archive, so
    Spark retries it; ``PERMISSIVE`` keeps the records before the damage and adds
    a row with ``error`` set.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return ARCHIVE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _WarcReader(self.options["path"], _is_permissive(self.options.get("mode")))


def _is_permissive(mode: str | None) -> bool:
    mode = (mode or "FAILFAST").upper()
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"unknown mode {mode}")
    return mode == "PERMISSIVE"


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)


def read_archives(
    paths: DataFrame,
    path: str = "path",
    rec_type: str | None = "response",
    mode: str = "FAILFAST",
    partitions: int | None = None,
    timed: bool = False,
    report: bool = False,
) -> DataFrame:
    """Records of the archives that a manifest (batch or stream) names.

    The paths are spread over ``partitions`` tasks, one per path if not given (on a
    stream, Spark's shuffle setting); the archives never pass through the driver.
    Only records of ``rec_type`` are decoded; ``None`` reads all. ``timed`` adds a column ``times``,
    null for records, and a row for each archive that holds its measured times in it. ``report``
    makes archives out of reach rows with an error, instead of failing tasks.
    """
    permissive = _is_permissive(mode)
    wanted = {rec_type} if rec_type else None

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                yield from archive_batches(name, wanted, permissive, timed, report)

    named = paths.select(path)
    if partitions is None and not paths.isStreaming:
        partitions = max(1, named.count())
    spread = named.repartition(partitions) if partitions else named.repartition(path)
    schema = f"{ARCHIVE_SCHEMA}, times {TIMES_SCHEMA}" if timed else ARCHIVE_SCHEMA
    return spread.mapInArrow(scan, schema)
