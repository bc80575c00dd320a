"""Segments of texts as array column or as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagevane.functions.segment import MAX_WORDS, OVERLAP_SENTENCES, segment_text
from pagevane.operators.extract import compute_once


def with_segments(
    df: DataFrame,
    text: str = "text",
    max_words: int = MAX_WORDS,
    overlap_sentences: int = OVERLAP_SENTENCES,
    drop_empty: bool = False,
) -> DataFrame:
    """Add ``segments``, an ordered array of strings."""
    column = segment_text(F.col(text), max_words, overlap_sentences, drop_empty)
    return compute_once(df, segments=column)


def explode_segments(df: DataFrame, *keys: str, keep_empty: bool = False) -> DataFrame:
    """One row per segment: ``keys, seg_no, segment``; ``seg_no`` counts from 0.

    ``keep_empty`` keeps a row with nulls for a text without segments.
    """
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return df.select(*keys, explode("segments").alias("seg_no", "segment"))


def segment_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.size("segments").alias("n_segments"))
