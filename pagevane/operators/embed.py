"""Segments to vectors, vectors to one unit vector per document."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagevane.functions.segment import MAX_WORDS, OVERLAP_SENTENCES
from pagevane.functions.text import tokens
from pagevane.functions.vectors import DIM, NORM_FLOOR, l2_normalize, token_code
from pagevane.operators.segments import with_segments

ENCODE_BATCH = 512

# An encoder turns n texts into an (n, dim) matrix; a factory builds it once per
# Python worker, where a real model would load its weights.
Encoder = Callable[[list[str]], np.ndarray]
EncoderFactory = Callable[[], Encoder]


@lru_cache(maxsize=1 << 18)
def _token_code(token: str, dim: int) -> int:
    """The rule of ``functions.vectors.token_code``; frequent tokens are remembered."""
    h = int(hashlib.md5(token.encode("utf-8")).hexdigest()[:9], 16)
    return ((h >> 4) % dim) * 2 + h % 2


class HashingEncoder:
    """Signed feature hashing to unit vectors: the encoder used when no model is given.

    Tokens are dictionary-encoded per batch, so md5 runs once per distinct token.
    """

    def __init__(self, dim: int = DIM):
        self.dim = dim

    def __call__(self, texts: list[str]) -> np.ndarray:
        lowered = pc.utf8_lower(pa.array(texts, pa.large_string()))
        split = pc.split_pattern_regex(lowered, r"[^\pL\pN]+")
        words = pc.list_flatten(split).dictionary_encode()
        rows = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
        vocabulary = words.dictionary.to_numpy(zero_copy_only=False)
        codes = [_token_code(t, self.dim) if t else -1 for t in vocabulary]
        codes = np.array(codes, dtype=np.int64)
        codes = codes[words.indices.to_numpy()] if len(vocabulary) else codes
        rows, codes = rows[codes >= 0], codes[codes >= 0]
        cells = np.bincount(
            rows * self.dim + (codes >> 1),
            weights=1.0 - 2.0 * (codes & 1),
            minlength=len(texts) * self.dim,
        )
        return _unit_rows(cells.reshape(len(texts), self.dim))


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.maximum(norms, NORM_FLOOR)


def _float_lists(matrix: np.ndarray, present: np.ndarray) -> pa.Array:
    """Rows of ``matrix`` as list<float>, null where ``present`` is false."""
    dim = matrix.shape[1]
    ends = np.concatenate([[0], np.cumsum(np.where(present, dim, 0))])
    offsets = pa.array(ends, pa.int32(), mask=np.append(~present, False))
    values = pa.array(matrix[present].ravel(), pa.float32())
    return pa.ListArray.from_arrays(offsets, values)


def _pool_lists(encode: Encoder, lists: pa.Array, batch_size: int) -> pa.Array:
    """Encode all segments of a batch of documents, average and scale per document."""
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(lists)), counts)
    flat = lists.flatten()
    sums = None
    for at in range(0, len(flat), batch_size):
        vectors = np.asarray(encode(flat.slice(at, batch_size).to_pylist()), dtype=np.float64)
        if sums is None:
            sums = np.zeros((len(lists), vectors.shape[1]))
        owners = owner[at : at + batch_size]
        first = np.flatnonzero(np.diff(owners, prepend=-1))
        sums[owners[first]] += np.add.reduceat(vectors, first, axis=0)
    if sums is None:
        return pa.nulls(len(lists), pa.list_(pa.float32()))
    means = sums / np.maximum(counts, 1)[:, None]
    return _float_lists(_unit_rows(means), counts > 0)


def embed_segments(
    segments: Column | str,
    encoder: EncoderFactory = HashingEncoder,
    batch_size: int = ENCODE_BATCH,
) -> Column:
    """Array of segments -> unit mean vector (``array<float>``), null without segments.

    Mean and scaling happen in the task that encodes, so documents never shuffle.
    """

    @F.arrow_udf("array<float>")
    def pooled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder()
        for lists in batches:
            yield _pool_lists(encode, lists, batch_size)

    # Declared non-deterministic, so Catalyst never runs the encoder a second time
    # to test a filter on its result.
    once = pooled.asNondeterministic()
    return once(F.col(segments) if isinstance(segments, str) else segments)


def encode_segments(
    segments: DataFrame,
    encoder: EncoderFactory = HashingEncoder,
    segment: str = "segment",
    batch_size: int = ENCODE_BATCH,
) -> DataFrame:
    """Segment rows with their own vector added as ``embedding``."""

    @F.arrow_udf("array<float>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder()
        for texts in batches:
            parts = [
                encode(texts.slice(at, batch_size).to_pylist())
                for at in range(0, len(texts), batch_size)
            ]
            matrix = np.vstack(parts)
            yield _float_lists(matrix, np.ones(len(matrix), dtype=bool))

    once = encoded.asNondeterministic()
    return segments.select("*", once(F.col(segment)).alias("embedding"))


def embed_documents(
    df: DataFrame,
    text: str = "text",
    encoder: EncoderFactory = HashingEncoder,
    max_words: int = MAX_WORDS,
    overlap_sentences: int = OVERLAP_SENTENCES,
) -> DataFrame:
    """Replace the text column by ``embedding``; texts without segments get null."""
    segmented = with_segments(df, text, max_words, overlap_sentences)
    return segmented.select("*", embed_segments("segments", encoder).alias("embedding")).drop(
        text, "segments"
    )


def hash_encode(
    segments: DataFrame,
    *keys: str,
    segment: str = "segment",
    dim: int = DIM,
    partitions: int | None = None,
) -> DataFrame:
    """Feature hashing without Python: sparse unit vectors ``keys, bucket, weight``.

    Segments are spread by key once; counting, the norm and the scaling then all
    find their rows in place. Cells that cancel out are left out, so a zero vector
    has no rows.

    Cells take many times the bytes of their text, so tasks are not put together by the bytes
    that are shuffled: there are ``partitions`` of them, or else as many as the session shuffles into.
    """
    count = partitions or int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    codes = (
        segments.repartition(count, *keys)
        .select(*keys, F.explode(tokens(segment)).alias("token"))
        .select(*keys, token_code("token", dim).alias("code"))
    )
    sign = F.lit(1) - F.lit(2) * F.col("code").bitwiseAND(1)
    cells = (
        codes.groupBy(*keys, F.shiftright("code", 1).alias("bucket"))
        .agg(F.sum(sign).alias("value"))
        .filter("value <> 0")
    )
    value = F.col("value").cast("double")
    norm = F.sqrt(F.sum(value * value).over(Window.partitionBy(*keys)))
    return cells.select(*keys, "bucket", (value / norm).alias("weight"))


def mean_pool(df: DataFrame, *keys: str, vector: str = "embedding") -> DataFrame:
    """Element-wise mean of the vectors of each key, as ``array<double>``.

    Each task folds its rows into one vector per key before the shuffle, so a key
    that holds a large share of all rows sends no more than any other.
    """
    as_vector = array_to_vector(F.col(vector).cast("array<double>"))
    return df.groupBy(*keys).agg(vector_to_array(Summarizer.mean(as_vector)).alias("mean"))


def document_embeddings(df: DataFrame, *keys: str, vector: str = "embedding") -> DataFrame:
    """``mean_pool`` scaled to unit length: ``keys, embedding``."""
    return mean_pool(df, *keys, vector=vector).select(
        *keys, l2_normalize("mean").alias("embedding")
    )


def dim_check(df: DataFrame, dim: int = DIM, vector: str = "embedding") -> DataFrame:
    """Add ``dim_ok``: the vector exists and has the length the index declares."""
    size = F.size(F.col(vector))
    return df.withColumn("dim_ok", F.col(vector).isNotNull() & (size == dim))
