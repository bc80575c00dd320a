"""Language of a text by a vote of its function words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagevane.functions.text import col, let

# Function words per language, in tie-breaking order. A word used
# in two languages stands in both lists.
STOP_WORDS: dict[str, list[str]] = {
    "en": "the of and to in is that for with are was on as by this a".split(),
    "de": "der die das und ist nicht sich den dem von mit für des ein zu".split(),
    "es": "el la que de un en los las y por para con del se no su lo es una".split(),
    "fr": "le la les des du et est une dans que qui pour elle sur au un de en".split(),
}
UNDETERMINED = "und"
NON_LETTERS = r"[^\p{L}]+"


def _is_in(words: list[str]):
    return lambda token: token.isin(*words)


def detect_lang(text: Column | str, words: dict[str, list[str]] | None = None) -> Column:
    """ISO code of the language with most function words, ``und`` if none occurs.

    Deterministic; ties go to the language listed first.
    """
    words = words or STOP_WORDS
    known = sorted({w for ws in words.values() for w in ws})
    # One pass over the text keeps the function words; the votes then read the
    # much shorter list.
    hits = F.filter(F.split(F.lower(col(text)), NON_LETTERS), _is_in(known))

    def vote(found: Column) -> Column:
        return F.array(*[F.size(F.filter(found, _is_in(ws))) for ws in words.values()])

    def winner(counts: Column) -> Column:
        best = F.array_max(counts)
        codes = F.array(*[F.lit(code) for code in words])
        first = F.array_position(counts, best).cast("int")
        return F.when(best > 0, F.element_at(codes, first)).otherwise(F.lit(UNDETERMINED))

    return let(let(hits, vote), winner)
