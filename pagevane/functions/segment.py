"""Sentences, and sentences packed into overlapping word-limited segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagevane.functions.text import NON_SPACE, SPACE, col, has_odd_spaces, let, plain_spaces

MAX_WORDS = 150
OVERLAP_SENTENCES = 2
SENTENCE_MARK = "\u0001"
SENTENCE_END = rf"([.!?]){SPACE}+"


def _ascii_word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"\s+"), lambda w: w != ""))


def word_count(c: Column | str) -> Column:
    """Number of runs of non-white-space characters."""
    return let(col(c), lambda t: _ascii_word_count(plain_spaces(t)))


def sentence_split(text: Column | str) -> Column:
    """Sentences of a text in order: cut after ``.``, ``!`` or ``?`` before white space."""
    marked = F.regexp_replace(col(text), SENTENCE_END, "$1" + SENTENCE_MARK)
    return F.filter(F.split(marked, SENTENCE_MARK), lambda s: s.rlike(NON_SPACE))


def _pack(sentences: Column, sizes: Column, max_words: int, overlap: int) -> Column:
    """Fold over the sentence sizes; returns the (start, length) of each segment.

    The state carries positions and one word total only, never strings, so a
    step costs the same however long the text is.
    """
    span = "array<struct<start:int,len:int>>"
    zero = F.struct(
        F.array().cast(span).alias("spans"),
        F.lit(0).alias("start"),
        F.lit(0).alias("at"),
        F.lit(0).alias("words"),
    )

    def spans_with_current(s: Column) -> Column:
        current = F.struct(s["start"].alias("start"), (s["at"] - s["start"]).alias("len"))
        return F.concat(s["spans"], F.array(current).cast(span))

    def step(s: Column, k: Column) -> Column:
        over = s["words"] + k > max_words
        carried = F.least(F.lit(overlap), s["at"] - s["start"])
        carried_words = F.aggregate(
            F.slice(sizes, s["at"] - carried + 1, carried), F.lit(0), lambda a, x: a + x
        )
        return F.struct(
            F.when(over, spans_with_current(s)).otherwise(s["spans"]).alias("spans"),
            F.when(over, s["at"] - carried).otherwise(s["start"]).alias("start"),
            (s["at"] + 1).alias("at"),
            (F.when(over, carried_words).otherwise(s["words"]) + k).alias("words"),
        )

    def finish(s: Column) -> Column:
        return F.when(s["at"] > 0, spans_with_current(s)).otherwise(s["spans"])

    return F.aggregate(sizes, zero, step, finish)


def segment_text(
    text: Column | str,
    max_words: int = MAX_WORDS,
    overlap_sentences: int = OVERLAP_SENTENCES,
    drop_empty: bool = False,
) -> Column:
    """Segments of at most ``max_words`` words that share ``overlap_sentences`` sentences.

    A segment closes when the next sentence would exceed the limit; the next one
    starts with the last sentences of the closed one. The limit is not checked
    again after that carry-over, so a segment may be longer; and if the very first
    sentence is over the limit, an empty segment precedes it (``drop_empty``
    removes it). With ``overlap_sentences=0`` nothing is carried over.
    """
    if max_words < 1 or overlap_sentences < 0:
        raise ValueError("max_words must be >= 1 and overlap_sentences >= 0")

    def pack(sentences: Column) -> Column:
        # The scan for rare white space is made once per text, not per sentence.
        sizes = F.when(has_odd_spaces(text), F.transform(sentences, word_count)).otherwise(
            F.transform(sentences, _ascii_word_count)
        )
        spans = let(sizes, lambda ks: _pack(sentences, ks, max_words, overlap_sentences))
        return F.transform(
            spans, lambda b: F.array_join(F.slice(sentences, b["start"] + 1, b["len"]), " ")
        )

    segments = let(sentence_split(text), pack)
    return F.filter(segments, lambda s: s != "") if drop_empty else segments
