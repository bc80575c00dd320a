"""What the operators of this subpackage share: columns, tables, batches and hashes.

Rules that hold for every operator here:

* A null text is an empty text. No row is dropped for a null in any column.
* Only the id and the text (and columns named in a signature) are read, so further
  columns, whatever their names, are neither read nor in the way.
"""

from __future__ import annotations

import atexit
import ctypes
import hashlib
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagevane.session import shared_dir

# Text bytes that one vectorised step works on, small enough for its arrays to stay in cache; a
# longer single text is one step.
STEP_BYTES = 1 << 19
# Bounds of an Arrow batch, so that a run of long texts doesn't fill a worker's memory.
BATCH_ROWS = "2000"
BATCH_BYTES = str(32 << 20)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of texts small in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns of ``df``, by position of the first match."""
    return df.select(*(df[c] for c in columns))


def written(df: DataFrame) -> DataFrame:
    """``df`` stored as a table in the shared folder, and read again.

    What is read several times is made once, and its lineage ends there: the loss of an
    executor costs no more than the tasks that it ran. The folder is removed with the session's
    end (see ``_remove_at_end``).
    """
    spark = df.sparkSession
    path = f"{_work_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_work: dict[str, str] = {}


def _work_folder(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _work:
        _work[app] = f"{shared_dir(spark).rstrip('/')}/pagevane-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_remove_at_end, spark, _work[app])
    return _work[app]


def _remove_at_end(spark: SparkSession, path: str) -> None:
    """Remove the session's tables, if the session is still there when Python ends."""
    if spark.sparkContext._jsc is None:
        return
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _in_blocks(rows: DataFrame, keys: list[str], order: list[str], glue: bytes) -> DataFrame:
    """Neighbouring pieces of a key as one, of up to about ``STEP_BYTES``: ``keys, _part, _run, _piece``."""
    sorted_ = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    schema = rows.select(*keys).schema.add("_part", T.IntegerType()).add("_run", T.LongType()).add("_piece", T.StringType())
    names = schema.fieldNames()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, run, now, held, size = TaskContext.get().partitionId(), 0, None, [], 0
        for batch in batches:
            kinds = [batch.schema.field(k).type for k in keys] + [pa.int32(), pa.int64(), pa.string()]
            done = []
            for *key, text in zip(*(batch.column(c).to_pylist() for c in (*keys, "_piece"))):
                data = (text or "").encode()
                if held and (key != now or size > STEP_BYTES):
                    done.append([*now, part, run, glue.join(held).decode()])
                    run, held, size = run + 1, [], 0
                now = key
                held.append(data)
                size += len(data)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
        if held:
            last = [*now, part, run, glue.join(held).decode()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(last, kinds)], names)

    return sorted_.mapInArrow(build, schema)


def joined_sha256(
    rows: DataFrame, keys: list[str], order: list[str], piece: Column, between: str, name: str, short: bool = False
) -> DataFrame:
    """SHA-256 (lower-case hex, column ``name``) of a key's pieces in their order, joined by ``between``.

    Pieces stream through the task that holds the key, so that no key's pieces are ever held together. Many
    ``short`` ones are first joined where they lie, dealt by ranges, so that the key's task reads few rows.
    Keys aren't null.
    """
    dealt = rows.select(*keys, *order, piece.alias("_piece"))
    if short:
        dealt, order = _in_blocks(dealt, keys, order, between.encode()), ["_part", "_run"]
    dealt = dealt.repartition(*keys)
    fields = dealt.select(*keys).schema
    names = [*keys, name]
    glue = between.encode()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running, kinds = None, None, None
        for batch in batches:
            kinds = [batch.schema.field(k).type for k in keys] + [pa.string()]
            done = []
            for *key, text in zip(*(batch.column(c).to_pylist() for c in (*keys, "_piece"))):
                data = (text or "").encode()
                if key == now:
                    running.update(glue + data)
                    continue
                if now is not None:
                    done.append([*now, running.hexdigest()])
                now, running = key, hashlib.sha256(data)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
        if now is not None:
            last = [*now, running.hexdigest()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(last, kinds)], names)

    sorted_ = dealt.sortWithinPartitions(*keys, *order)
    return sorted_.mapInArrow(digest, fields.add(name, T.StringType()))


# --- arrays of a fixed size, gathered from all rows -----------------------------------

BLOCKS = 64


def gathered(
    df: DataFrame, size: int, dtype: str, fill: Callable[[np.ndarray, pa.RecordBatch], None]
) -> np.ndarray:
    """An array of ``size`` items: each task fills its own, and they are added up (bits: or-ed).

    ``size`` is a parameter, whatever the number of rows, and so bounds what reaches the driver.
    The tasks' arrays meet in blocks, as a stream, so that no task holds more than one array.
    """
    wide = size // BLOCKS
    merge = np.bitwise_or if dtype == "uint8" else np.add

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = np.zeros(size, dtype)
        for batch in batches:
            fill(items, batch)
        parts = [(k, items[k * wide : (k + 1) * wide]) for k in range(BLOCKS)]
        parts = [(k, x.tobytes()) for k, x in parts if x.any()]
        yield _blocks(parts)

    def all_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(x, dtype)
                items[k] = merge(items[k], part) if k in items else part
        yield _blocks([(k, x.tobytes()) for k, x in items.items()])

    schema = "block int, items binary"
    parts = df.mapInArrow(one, schema).repartition(BLOCKS, "block").mapInArrow(all_, schema)
    out = np.zeros(size, dtype)
    for row in parts.collect():
        out[row["block"] * wide : (row["block"] + 1) * wide] = np.frombuffer(row["items"], dtype)
    return out


def _blocks(parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
    numbers = pa.array([k for k, _ in parts], pa.int32())
    return pa.RecordBatch.from_arrays([numbers, pa.array([x for _, x in parts], pa.binary())], ["block", "items"])


BLOOM_BITS = 1 << 26


def bloom(df: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over the one column (a long) of ``df``.

    It only saves work: what passes it is joined exactly afterwards. When it fills up, more
    passes, and nothing is lost.
    """

    def fill(bits: np.ndarray, batch: pa.RecordBatch) -> None:
        for at in _bloom_places(batch.column(0).to_numpy(zero_copy_only=False)):
            np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    return gathered(df, BLOOM_BITS // 8, "uint8", fill)


def in_bloom(bits: np.ndarray, items: np.ndarray) -> np.ndarray:
    found = np.ones(len(items), bool)
    for at in _bloom_places(items):
        found &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def seems_in(bits: np.ndarray, items: pa.Array) -> np.ndarray:
    """Whether each long is in a Bloom filter, or seems to be; null is not."""
    found = in_bloom(bits, items.fill_null(0).to_numpy(zero_copy_only=False))
    return found & items.is_valid().to_numpy(zero_copy_only=False)


def likely_in(bits: Broadcast, column: str | Column) -> Column:
    """Whether a long is in a broadcast Bloom filter, or seems to be; null is not."""

    @F.arrow_udf("boolean")
    def likely(items: pa.Array) -> pa.Array:
        return pa.array(seems_in(bits.value, items))

    return likely(F.col(column) if isinstance(column, str) else column)


def _bloom_places(items: np.ndarray) -> list[np.ndarray]:
    x = mixed(np.ascontiguousarray(items).view(np.uint64))
    mask = np.uint64(BLOOM_BITS - 1)
    return [x & mask, (x >> np.uint64(26)) & mask, mixed(x ^ _FACTORS[200]) & mask]


# --- batches of texts ---------------------------------------------------------------


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in one array, and where each text starts (one more at the end)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, values = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def steps(offsets: np.ndarray, size: int = STEP_BYTES, trim: bool = False) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes each, of one row at least; ``trim`` hands memory back at the end."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last
    if trim:
        give_back()


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library
        return None


def give_back() -> None:
    """Hand memory that a batch needed back to the system: a worker lives on, and its next work needs other arrays."""
    pa.default_memory_pool().release_unused()
    if _trim() is not None:
        _trim()(0)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = mixed(np.arange(1, 513, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE = _SEEDS[:256] | np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_FACTORS = _SEEDS[256:] | np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a run of texts, with a 64-bit hash of each.

    ``start`` and ``end`` are byte positions, ``row`` the text a word belongs to, ``first``
    the number of each text's first word (one more at the end).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        n = len(data)
        word = ~IS_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1] | edge[1:n]
        ends[:-1] &= ~word[1:] | edge[1:n]
        self.data, self.offsets = data, offsets
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        self.first = np.searchsorted(self.row, np.arange(len(offsets)))
        self.hash = self._hashes(word, begins, _LOWER if lower else _BYTE)

    def __len__(self) -> int:
        return len(self.start)

    def _hashes(self, word: np.ndarray, begins: np.ndarray, codes: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        powers = np.multiply.accumulate(np.full(int(length.max()) + 1, _BASE))
        number = np.cumsum(begins) - 1
        place = np.arange(len(word)) - self.start[np.maximum(number, 0)]
        terms = np.where(word, codes[self.data] * powers[np.where(word, place, 0)], np.uint64(0))
        return mixed(np.add.reduceat(terms, self.start) + length.astype(np.uint64))

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``k`` words from each word on, and whether they are of one text."""
        n = max(len(self.hash) - k + 1, 0)
        total = np.zeros(n, np.uint64)
        for i in range(k):
            total += self.hash[i : i + n] * _FACTORS[i]
        return mixed(total), self.row[:n] == self.row[k - 1 : k - 1 + n]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
