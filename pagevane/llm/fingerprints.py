"""Document fingerprints by locally consistent parsing.

A text's bytes are parsed into phrases, phrases into phrases of phrases, and so on. A level
first joins runs of equal symbols. Deterministic coin tossing then labels each symbol by where
it differs from the one before it, again and again, until labels are below 6; a phrase begins at
each local minimum of the labels. Where phrases begin depends only on a few symbols on both
sides, so that equal substrings are parsed alike inside, whatever stands around them and at
whatever offset. A phrase's name is a hash of the names in it.

The fingerprint keeps, for each of several levels, the smallest ranks of the level's distinct
names. The likeness of two fingerprints is the mean over levels of the estimated Jaccard
similarity of the sets of names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mixed, small_batches, steps, text_of, utf8

# Levels that are kept: phrases of about 9, 30 and 90 bytes.
LEVELS = (2, 3, 4)
KEEP = 32
# Texts are put side by side in runs of about this size to pair each with the next one.
RUN_BYTES = 8 << 20


def _toss_table(size: int) -> np.ndarray:
    """``[before, symbol]`` to ``2 * place + bit`` of the lowest bit in which both differ."""
    a, b = np.meshgrid(np.arange(size), np.arange(size), indexing="ij")
    differ = a ^ b
    low = differ & -differ
    place = np.where(differ == 0, 0, np.log2(np.maximum(low, 1)).astype(np.int64))
    return (2 * place + ((b >> place) & 1)).astype(np.uint8).ravel()


_BYTES = _toss_table(256)  # labels below 16
_SMALL = _toss_table(128)
_NAMES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTOR = np.uint64(0x9FB21C651E98DF25)


def _toss(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6 from symbols of which no two neighbours of one text are equal.

    ``first`` marks the first symbol of each text, which is labelled by its own lowest bit.
    """
    before = np.roll(symbols, 1)
    if symbols.dtype == np.uint8:
        labels = _BYTES[(before.astype(np.uint16) << np.uint16(8)) | symbols]
        labels[first] = symbols[first] & 1
        bound = 16
    else:
        differ = before ^ symbols
        low = differ & (~differ + np.uint64(1))
        place = np.zeros(len(symbols), np.uint64)
        some = low > 0
        place[some] = np.log2(low[some].astype(np.float64)).astype(np.uint64)
        labels = (np.uint64(2) * place + ((symbols >> place) & np.uint64(1))).astype(np.uint8)
        labels[first] = (symbols[first] & np.uint64(1)).astype(np.uint8)
        bound = 128
    while bound > 6:
        before = np.roll(labels, 1)
        again = _SMALL[(before.astype(np.uint16) << np.uint16(7)) | labels]
        again[first] = labels[first] & 1
        labels = again
        bound = 2 * max((bound - 1).bit_length(), 1)
        if bound == 6:
            break
    return labels


def parse(symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of each text one level up, and where each text's phrases start."""
    n = len(symbols)
    if not n:
        return np.zeros(0, np.uint64), offsets
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    names = _NAMES[symbols] if symbols.dtype == np.uint8 else symbols
    # Runs of equal symbols become one symbol.
    head = edge[:n].copy()
    head[1:] |= symbols[1:] != symbols[:-1]
    head[0] = True
    at = np.flatnonzero(head)
    first = edge[at]
    names, symbols = names[at], symbols[at]
    length = np.diff(np.append(at, n)).astype(np.uint64)
    names = np.where(length > 1, mixed(names + length * _FACTOR), names)
    labels = _toss(symbols, first)
    m = len(symbols)
    begins = first.copy()
    if m > 2:
        # A text's last symbol is compared with no other text's first one.
        inner = (labels[1:-1] < labels[:-2]) & (labels[1:-1] <= labels[2:]) & ~first[2:]
        begins[1:-1] |= inner
        # A phrase of one symbol joins the one before it, but at a text's start.
        single = begins[1:] & begins[:-1] & ~first[1:]
        begins[1:] &= ~single
    starts = np.flatnonzero(begins)
    place = np.arange(m) - np.repeat(starts, np.diff(np.append(starts, m)))
    powers = np.multiply.accumulate(np.full(int(place.max()) + 1, _FACTOR))
    up = mixed(np.add.reduceat(mixed(names) * powers[place], starts))
    bounds = np.searchsorted(at[starts], offsets)
    return up, bounds


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Hex fingerprint of each text: ``KEEP`` ranks of 32 bits for each level, joined by ``:``."""
    levels = []
    symbols, at = data, offsets
    for level in range(1, max(LEVELS) + 1):
        symbols, at = parse(symbols, at)
        if level in LEVELS:
            levels.append((mixed(symbols ^ np.uint64(level)) >> np.uint64(32)).astype(">u4"))
            levels.append(at)
    out = []
    for i in range(len(offsets) - 1):
        parts = []
        for names, at in zip(levels[::2], levels[1::2]):
            own = np.unique(names[at[i] : at[i + 1]])[:KEEP]
            parts.append(own.astype(">u4").tobytes().hex())
        out.append(":".join(parts))
    return out


def likeness(a: str, b: str) -> float:
    """Mean over levels of the estimated Jaccard similarity; both empty: 1."""
    found = []
    for x, y in zip(a.split(":"), b.split(":")):
        if not x and not y:
            continue
        p = {x[i : i + 8] for i in range(0, len(x), 8)}
        q = {y[i : i + 8] for i in range(0, len(y), 8)}
        least = sorted(p | q)
        # With fewer names than are kept, the sets are whole.
        if len(p) == KEEP or len(q) == KEEP:
            least = least[:KEEP]
        found.append(sum(v in p and v in q for v in least) / len(least))
    return sum(found) / len(found) if found else 1.0


def of_texts(texts: list[str]) -> list[str]:
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    out = []
    for lo, hi in steps(offsets):
        at = offsets[lo : hi + 1]
        out += fingerprints(data[at[0] : at[-1]], at - at[0])
    return out


# --- each text and the next one ------------------------------------------------------


def _boundaries(spark: SparkSession, rows: DataFrame) -> list[int]:
    """Ids that cut the rows into runs of about equal bytes of text, in order of id."""
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    runs = max(int(size // RUN_BYTES), 1)
    if runs == 1:
        return []
    at = [i / runs for i in range(1, runs)]
    found = rows.select(F.percentile_approx("id", [float(x) for x in at], 10_000)).first()[0]
    return sorted(set(found or []))


def edited_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has its last ``n_chars // 2`` code points replaced by the first as many of
    the next document by id; after the last comes the first. Rows with a null id come before all
    others, and rows of one id in the order of their texts. A null text is empty. A single row
    is its own next one.

    Rows are cut by id into runs; the first row of a run also goes to the run before it, so
    that every row finds its next one in its run, and texts are shuffled once. A run is sorted and
    streamed.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(docs[id].cast("long").alias("id"), text_of(docs[text]).alias("text"))
    cuts = _boundaries(spark, rows)
    run = F.coalesce(_run_of(cuts), F.lit(0)) if cuts else F.lit(0)
    placed = rows.withColumn("run", run.cast("int")).withColumn("h", F.xxhash64("text"))
    # One row of three numbers for each run of RUN_BYTES.
    heads = placed.groupBy("run").agg(F.min(F.struct("id", "h")).alias("head")).collect()
    heads = sorted((r["run"], r["head"]["id"], r["head"]["h"]) for r in heads)
    before = [heads[i - 1][0] for i in range(len(heads))]
    targets = spark.createDataFrame(
        [(*head, to) for head, to in zip(heads, before)], "run int, hid long, hh long, to int"
    )
    ghosts = (
        placed.join(F.broadcast(targets), "run")
        .filter(F.col("id").eqNullSafe(F.col("hid")) & (F.col("h") == F.col("hh")))
        .dropDuplicates(["run"])
        .select("id", "text", F.col("to").alias("run"), F.lit(1).alias("ghost"), "h")
    )
    both = placed.select("id", "text", "run", F.lit(0).alias("ghost"), "h").union(ghosts)
    both = both.repartition(max(len(heads), 1), "run").sortWithinPartitions("run", "ghost", "id", "h")
    schema = (
        f"`{id}` long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return both.select("id", "text", "run", "ghost").mapInArrow(lambda b: _streamed(b, id), schema)


def _run_of(cuts: list[int]) -> Column:
    """Number of cuts at or below the id; null for a null id."""

    @F.arrow_udf("int")
    def run(ids: pa.Array) -> pa.Array:
        at = np.searchsorted(cuts, ids.fill_null(0).to_numpy(zero_copy_only=False), "right")
        return pa.array(at.astype(np.int32), mask=ids.is_null().to_numpy(zero_copy_only=False))

    return run("id")


def _streamed(batches: Iterator[pa.RecordBatch], id: str) -> Iterator[pa.RecordBatch]:
    held: tuple | None = None  # the row whose next one is still to come
    for batch in batches:
        ids, texts, runs, ghosts = (batch.column(i).to_pylist() for i in range(4))
        _, offsets = utf8(batch.column(1))
        for lo, hi in steps(offsets):
            rows = list(zip(ids[lo:hi], texts[lo:hi], runs[lo:hi], ghosts[lo:hi], of_texts(texts[lo:hi])))
            if held is not None:
                rows.insert(0, held)
            done = [(a, b) for a, b in zip(rows, rows[1:]) if a[2] == b[2] and not a[3]]
            yield _made(done, id)
            held = rows[-1]


def _made(pairs: list[tuple[tuple, tuple]], id: str) -> pa.RecordBatch:
    edited = []
    for (_, text, *_), (_, following, *_) in pairs:
        half = len(text) // 2
        edited.append(text[: len(text) - half] + following[:half])
    prints = of_texts(edited)
    columns = [
        pa.array([a[0] for a, _ in pairs], pa.int64()),
        pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        pa.array([a[4] for a, _ in pairs], pa.string()),
        pa.array(prints, pa.string()),
        pa.array([likeness(a[4], e) for (a, _), e in zip(pairs, prints)], pa.float64()),
        pa.array([likeness(a[4], b[4]) for a, b in pairs], pa.float64()),
    ]
    names = [id, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays(columns, names)
