"""Language of texts by hashed character n-grams: a small model, scored row by row.

Training counts the n-grams of labelled texts in ``BINS`` bins a language, so the model has
``BINS * len(languages)`` numbers whatever the corpus; that is what reaches the driver and the
tasks. Scoring is a narrow stage: nothing is shuffled and no table is joined.

A text's margin is what its best language leads by, per n-gram, in millionths of a nat. Texts
below the model's least margin are ``und``, and so are texts of which under half the n-grams are
known. The least margin comes from rows that are kept out of the counts: the smallest one from
which on ``PRECISION`` of those rows are right.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagevane.functions.language import NON_LETTERS, UNDETERMINED
from pagevane.functions.text import col
from pagevane.operators.language import LANGUAGES, WEIGHT_SCALE

# A prime, so that the bins of neighbouring characters don't fall together.
BINS = 16_381
FACTOR = 1009
PRECISION = 0.995
# A bin is known if it has this share of a language's n-grams. Rare bins hold what strays into a
# corpus; whether a bin is used doesn't change with the size of the corpus.
KNOWN = 1e-5
# Margins are looked at in steps of a hundredth of a nat; no text is accepted below the first.
MARGIN_STEP = WEIGHT_SCALE // 100
STEPS = 1000
# Characters that are looked at together, so that memory doesn't follow the longest text.
CHARACTERS = 1 << 16


@dataclass(frozen=True)
class LanguageModel:
    """``weights`` has a row for each bin and a column for each language."""

    languages: tuple[str, ...]
    weights: np.ndarray
    known: np.ndarray
    least_margin: int = MARGIN_STEP


def _letters(text: Column | str) -> Column:
    """Lower-case letters, with one space for whatever is between, in front and behind."""
    spaced = F.trim(F.regexp_replace(F.lower(F.coalesce(col(text), F.lit(""))), NON_LETTERS, " "))
    return F.when(spaced == "", "").otherwise(F.concat(F.lit(" "), spaced, F.lit(" ")))


def _bins(text: str, bins: int) -> Iterator[np.ndarray]:
    """Bins of the three-character runs of a text, piece by piece."""
    for first in range(0, max(len(text) - 2, 0), CHARACTERS):
        piece = text[first : first + CHARACTERS + 2]
        c = np.frombuffer(piece.encode("utf-32-le"), "<u4").astype(np.int64)
        yield ((c[:-2] * FACTOR + c[1:-1]) * FACTOR + c[2:]) % bins


def _counts(labelled: DataFrame, text: str, label: str, languages: tuple[str, ...], bins: int) -> np.ndarray:
    """N-grams by bin and language: each task adds up its own, of which the sums meet by bin."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((len(languages), bins), np.int64)
        for batch in batches:
            for code, letters in zip(batch.column(0).to_pylist(), batch.column(1)):
                for some in _bins(letters.as_py(), bins):
                    found[languages.index(code)] += np.bincount(some, minlength=bins)
        lang, bin_ = np.nonzero(found)
        columns = [pa.array(lang, pa.int32()), pa.array(bin_, pa.int32()), pa.array(found[lang, bin_])]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "bin", "n"])

    rows = labelled.filter(F.col(label).isin(*languages)).select(label, _letters(text).alias("letters"))
    parts = rows.mapInArrow(count, "lang int, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    counts = np.zeros((bins, len(languages)), np.int64)
    for r in parts.collect():
        counts[r["bin"], r["lang"]] = r["n"]
    return counts


def train_language_model(
    labelled: DataFrame,
    held_out: Column,
    text: str = "text",
    label: str = "lang",
    languages: tuple[str, ...] = LANGUAGES,
    bins: int = BINS,
    precision: float = PRECISION,
) -> LanguageModel:
    """A model of the rows that aren't ``held_out`` (a condition); those that are set its least margin.

    Rows with another label or none are left out. Without any row every text is ``und``.
    """
    fold = F.coalesce(held_out, F.lit(False))
    counts = _counts(labelled.filter(~fold), text, label, languages, bins)
    sums = counts.sum(axis=0)
    known = ((counts > 0) & (counts >= KNOWN * sums)).any(axis=1)
    share = (counts + 1) / (sums + bins)
    weights = np.where(known[:, None], np.rint(np.log(share) * WEIGHT_SCALE), 0).astype(np.int64)
    model = LanguageModel(languages, weights, known)
    rest = labelled.filter(fold & F.col(label).isin(*languages))
    rest = rest.select(label, language_scores(rest, model, text).alias("s")).filter("s.best is not null")
    step = F.least(F.floor(F.col("s.margin") / MARGIN_STEP), F.lit(STEPS)).cast("int")
    right = F.count_if(F.col("s.best") == F.col(label))
    steps = rest.groupBy(step.alias("step")).agg(F.count("*").alias("n"), right.alias("right")).collect()
    n, good = np.zeros(STEPS + 1), np.zeros(STEPS + 1)
    for r in steps:
        n[r["step"]], good[r["step"]] = r["n"], r["right"]
    n, good = np.cumsum(n[::-1])[::-1], np.cumsum(good[::-1])[::-1]
    enough = np.flatnonzero(good[1:] >= precision * n[1:])
    least = int(enough[0]) + 1 if len(enough) else STEPS
    return LanguageModel(languages, weights, known, least * MARGIN_STEP)


def language_scores(df: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """``best, margin, n_known`` of a text column of ``df``; ``best`` is null where under half the n-grams are known.

    ``n_known`` counts the known ones. Ties go to the language listed first, with a margin of 0. Null is an empty text.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("best string, margin long, n_known long")
    def score(texts: pa.Array) -> pa.Array:
        m: LanguageModel = shared.value
        best, margin, n_known = [], [], []
        for letters in texts:
            total, n, some = np.zeros(len(m.languages), np.int64), 0, 0
            for bins in _bins(letters.as_py(), len(m.weights)):
                total += m.weights[bins].sum(axis=0)
                n += len(bins)
                some += int(m.known[bins].sum())
            first = int(np.argmax(total))
            second = np.delete(total, first).max(initial=total[first] if len(total) == 1 else np.iinfo(np.int64).min)
            best.append(m.languages[first] if some and 2 * some >= n else None)
            margin.append(int(total[first] - second) // n if n else 0)
            n_known.append(some)
        columns = [pa.array(best, pa.string()), pa.array(margin, pa.int64()), pa.array(n_known, pa.int64())]
        return pa.StructArray.from_arrays(columns, ["best", "margin", "n_known"])

    return score.asNondeterministic()(_letters(df[text]))


def with_modelled_language(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``df`` with ``detected`` (``und`` below the least margin), ``margin`` and ``n_known``."""
    scored = df.withColumn("_language", language_scores(df, model, text))
    sure = (F.col("_language.margin") >= model.least_margin) & F.col("_language.best").isNotNull()
    return scored.select(
        *df.columns,
        F.when(sure, F.col("_language.best")).otherwise(UNDETERMINED).alias("detected"),
        "_language.margin",
        "_language.n_known",
    )
