"""Substring dedup by seed and extend on winnowed anchors.

Every window of ``length`` words has one anchor: the 5-word shingle with the smallest hash
in it, the last one of equals. Equal windows have equal anchors at equal places, so a repeat of
``length`` words or more can't be missed. A seed is an occurrence of an anchor, with the run of
windows that share it and a hash of the words under the run, the seed's extension as far as its
windows reach both ways.

Seeds are joined on the extension. All but the first seed of an extension are repeats as a
whole. Seeds whose anchor repeats with other extensions, and the first seed of each extension,
can still share part of their windows with each other (at the ends of a maximal repeat): they are
taken apart, and joined window by window. Neighbouring repeated windows unite to the maximal
repeated stretches, which are removed. No pairs of occurrences are made: each seed and each
window meets the first of its kind, whatever the number of copies.

Most anchors, extensions and windows occur once. For each of them the hashes alone are counted,
and a Bloom filter of fixed size keeps what occurs once from being shuffled with its place. Texts
are read for each of these passes, and shuffled once, to bring the words to be removed to them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    STEP_BYTES,
    Words,
    bloom,
    in_bloom,
    mixed,
    signed,
    small_batches,
    steps,
    text_of,
    utf8,
    written,
)

LENGTH = 20
ANCHOR = 5


class _Windows:
    """Windows of ``length`` words of a run of texts: their anchors, and runs of equal anchor."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        self.words = Words(data, offsets)
        row, n = self.words.row, len(self.words)
        count = max(n - length + 1, 0)
        anchors, _ = self.words.shingles(ANCHOR)
        self.starts = np.zeros(0, np.int64)
        if not count:
            return
        inside = row[:count] == row[length - 1 :]
        # Hash above, place below: the smallest is the smallest hash, the last of equals.
        shift = np.uint64(max(len(anchors).bit_length(), 1))
        last = np.uint64((1 << int(shift)) - 1)
        keyed = (anchors >> shift << shift) | (last - np.arange(len(anchors), dtype=np.uint64))
        least = _sliding_min(keyed, length - ANCHOR + 1)[:count]
        place = (last - (least & last)).astype(np.int64)
        first = inside.copy()
        first[1:] &= ~inside[:-1] | (place[1:] != place[:-1])
        starts = np.flatnonzero(first)
        if not len(starts):
            return
        ended = np.append(np.flatnonzero(~inside), count)
        stops = np.minimum(np.append(starts[1:], count), ended[np.searchsorted(ended, starts)])
        self.starts, self.n = starts, stops - starts
        self.anchor = anchors[place[starts]]
        # The words under the run, by differences of sums over the text's words.
        span = self.n + length - 1
        self.extension = mixed(
            _span_hashes(self.words.hash, starts, span)
            + (place[starts] - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            + span.astype(np.uint64)
        )


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    return x


def _span_hashes(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of the words of each span, in their order."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(starts), np.uint64)
    for i in range(int(lengths.max())):
        use = lengths > i
        word = hashes[np.minimum(starts + i, len(hashes) - 1)]
        total = np.where(use, mixed(total ^ word) + np.uint64(i), total)
    return total


def _parts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, offsets = utf8(texts)
    for first, last in steps(offsets, STEP_BYTES // 2):
        at = offsets[first : last + 1]
        yield first, data[at[0] : at[-1]], at - at[0]


def _list_array(rows: int, row: np.ndarray, columns: dict[str, np.ndarray]) -> pa.ListArray:
    """Items, sorted by row, as one list of structs for each row."""
    offsets = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    values = [pa.array(x) for x in columns.values()]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(values, list(columns)))


@dataclass
class _Known:
    """Broadcast Bloom filters, as far as they are known: of repeated anchors, extensions and
    windows, and of the places of the first seed of each repeated extension."""

    anchors: Broadcast | None = None
    extensions: Broadcast | None = None
    firsts: Broadcast | None = None
    windows: Broadcast | None = None


def _places(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return signed(mixed(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + starts.astype(np.uint64)))


def _found(rows: DataFrame, length: int, known: _Known, what: str) -> DataFrame:
    """``hash`` of every ``what`` (anchor, extension or window), with its place if that may repeat.

    Extensions are of seeds whose anchor repeats. Windows are of such seeds too, if their
    extension occurs once or they are its first. A place is ``id, twin, start, n``.
    """
    placed = {"anchor": None, "extension": known.extensions, "window": known.windows}[what]

    @F.arrow_udf("array<struct<hash:long,start:int,n:int>>")
    def items(ids: pa.Array, texts: pa.Array) -> pa.Array:
        ids = ids.to_numpy(zero_copy_only=False)
        row, hashes, start, n = ([np.zeros(0, np.int64)] for _ in range(4))
        for first, data, offsets in _parts(texts):
            w = _Windows(data, offsets, length)
            if not len(w.starts):
                continue
            at, of, count = w.starts, w.words.row[w.starts], w.n
            found = w.anchor if what == "anchor" else w.extension
            if known.anchors is not None:
                keep = in_bloom(known.anchors.value, w.anchor)
                if what == "window":
                    single = ~in_bloom(known.extensions.value, w.extension)
                    keep &= single | in_bloom(known.firsts.value, _places(ids[of + first], at - w.words.first[of]))
                at, of, count, found = at[keep], of[keep], count[keep], found[keep]
            if what == "window":
                inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                at, of = np.repeat(at, count) + inner, np.repeat(of, count)
                count = np.ones(len(at), np.int64)
                found = mixed(_span_hashes(w.words.hash, at, np.full(len(at), length)))
            if placed is not None:
                keep = in_bloom(placed.value, found)
                at, of, count, found = at[keep], of[keep], count[keep], found[keep]
            row.append(of + first)
            hashes.append(signed(found))
            start.append(at - w.words.first[of])
            n.append(count)
        columns = {
            "hash": np.concatenate(hashes),
            "start": np.concatenate(start).astype(np.int32),
            "n": np.concatenate(n).astype(np.int32),
        }
        return _list_array(len(texts), np.concatenate(row), columns)

    made = rows.select("id", "twin", items.asNondeterministic()("id", "text").alias("items"))
    if placed is None:
        return made.select(F.inline("items")).select("hash")
    return made.select("id", "twin", F.inline("items"))


def _repeated(hashes: DataFrame) -> Broadcast:
    """A Bloom filter of the hashes that occur more than once."""
    twice = hashes.groupBy("hash").agg(F.count("*").alias("c")).filter("c > 1").select("hash")
    return hashes.sparkSession.sparkContext.broadcast(bloom(twice))


def _later(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first place of each hash, and all places after the first of their hash."""
    first = written(placed.groupBy("hash").agg(F.min(F.struct("id", "start")).alias("first")))
    later = placed.join(first, "hash").filter(F.struct("id", "start") > F.col("first"))
    return first.select("first.*"), later.select("id", "twin", "start", "n")


def repeated_windows(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``id, twin, start, n``: ``n`` windows from ``start`` on whose words also start earlier.

    ``rows`` has ``id, twin, text``; earlier is a smaller ``id``, or the same and a smaller
    ``start``.
    """
    known = _Known()
    known.anchors = _repeated(_found(rows, length, known, "anchor"))
    known.extensions = _repeated(_found(rows, length, known, "extension"))
    firsts, later = _later(written(_found(rows, length, known, "extension")))

    @F.arrow_udf("long")
    def place(ids: pa.Array, starts: pa.Array) -> pa.Array:
        return pa.array(_places(ids.to_numpy(zero_copy_only=False), starts.to_numpy(zero_copy_only=False)))

    known.firsts = rows.sparkSession.sparkContext.broadcast(bloom(firsts.select(place("id", "start"))))
    known.windows = _repeated(_found(rows, length, known, "window"))
    _, again = _later(written(_found(rows, length, known, "window")))
    return later.union(again)


def _texts(docs: DataFrame, id: str, text: str) -> DataFrame:
    rows = docs.select(docs[id].alias("id"), text_of(docs[text]).alias("text"))
    return rows.withColumn("twin", F.xxhash64("text"))


def with_removed(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``id, text, removed`` of each row: ``removed`` lists ``start, n`` of the words that go.

    Null texts are empty ones. Rows with a null id keep all words and make no other row lose
    any. Rows that share an id are one document as to what is earlier; equal rows lose the same.
    """
    small_batches(docs.sparkSession)
    rows = _texts(docs, id, text)
    repeats = repeated_windows(rows.filter("id is not null"), length)
    # n windows from a start on cover n + length - 1 words.
    per_row = repeats.distinct().groupBy("id", "twin").agg(
        F.collect_list(F.struct("start", (F.col("n") + length - 1).alias("n"))).alias("removed")
    )
    kept = rows.join(per_row, ["id", "twin"], "left")
    return kept.select(F.col("id").alias(id), F.col("text").alias(text), "removed")


def _digest(texts: pa.Array, removed: pa.Array) -> pa.Array:
    n_words, n_removed, shas = [], [], []
    for kept, words in _kept_words(texts, removed):
        n_words.append(len(words))
        n_removed.append(len(words) - len(kept))
        shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
    columns = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(shas, pa.string())]
    return pa.StructArray.from_arrays(columns, ["n_words", "n_removed", "kept_sha256"])


def _kept_words(texts: pa.Array, removed: pa.Array) -> Iterator[tuple[list[bytes], list[bytes]]]:
    for text, spans in zip(texts.cast(pa.large_binary()), removed):
        words = text.as_py().split()
        if not spans.is_valid:
            yield words, words
            continue
        gone = np.zeros(len(words) + 1, np.int64)
        at = spans.values.field(0).to_numpy()
        np.add.at(gone, at, 1)
        np.add.at(gone, at + spans.values.field(1).to_numpy(), -1)
        keep = np.cumsum(gone)[:-1] == 0
        yield [w for w, k in zip(words, keep.tolist()) if k], words


def removal_digest(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``id, n_words, n_removed, kept_sha256`` of each row (see ``with_removed``)."""
    rows = with_removed(docs, id, text, length)
    digest = F.arrow_udf(_digest, "n_words long, n_removed long, kept_sha256 string").asNondeterministic()
    return rows.select(F.col(id), digest(F.col(text), "removed").alias("d")).select(id, "d.*")


# The digest by grouping the texts of all windows (20 words: five runs of four).
SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
w1 AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
w2 AS (SELECT *, concat_ws(' ', word, lead(word) OVER o) AS s2 FROM w1 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
w4 AS (SELECT * EXCLUDE s2, concat_ws(' ', s2, lead(s2, 2) OVER o) AS s4 FROM w2 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
w20 AS (
  SELECT * EXCLUDE s4, concat_ws(' ', s4, lead(s4, 4) OVER o, lead(s4, 8) OVER o, lead(s4, 12) OVER o, lead(s4, 16) OVER o) AS s20
  FROM w4 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
earliest AS (SELECT s20, min((doc_id, i)) AS first FROM w20 WHERE i + 19 <= n GROUP BY s20),
again AS (
  SELECT doc_id, i, word, i + 19 <= n AND first < (doc_id, i) AS again FROM w20 LEFT JOIN earliest USING (s20)),
gone AS (
  SELECT doc_id, i, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM again),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
