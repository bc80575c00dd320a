from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from pagevane.functions import segment_text, sentence_split, strip, word_count
from pagevane.operators import explode_segments, segment_counts, with_segments

from .conftest import table


def sentence(n_words: int, word: str = "w") -> str:
    return " ".join([word] * n_words) + "."


def text_of(*sizes: int) -> tuple[str, list[str]]:
    parts = [sentence(n, f"s{i}") for i, n in enumerate(sizes)]
    return " ".join(parts), parts


def segments(one, text, *args, **kwargs):
    return one(lambda c: segment_text(c, *args, **kwargs), text)


def brute(sentences, limit, overlap):
    """The packing rule, sentence by sentence."""
    closed, open_, size = [], [], 0
    for s in sentences:
        n = len(s.split())
        if size + n > limit:
            closed.append(" ".join(open_))
            open_ = open_[len(open_) - min(overlap, len(open_)) :]
            size = sum(len(x.split()) for x in open_)
        open_ = [*open_, s]
        size += n
    return closed + ([" ".join(open_)] if open_ else [])


def test_limit_is_strict(one):
    text, _ = text_of(100, 50)
    assert segments(one, text) == [text]


def test_overlap_may_exceed_the_limit(one):
    text, (a, b, c) = text_of(60, 60, 60)
    assert segments(one, text) == [f"{a} {b}", f"{a} {b} {c}"]


def test_overlap_of_a_short_list(one):
    text, (a, b) = text_of(100, 60)
    assert segments(one, text) == [a, f"{a} {b}"]


def test_long_first_sentence_leaves_an_empty_segment(one):
    text, _ = text_of(200)
    assert segments(one, text) == ["", text]
    assert segments(one, text, drop_empty=True) == [text]


@pytest.mark.parametrize("text", ["", "   ", " \n"])
def test_empty_text(one, text):
    assert segments(one, text) == []


def test_null_text(one):
    assert segments(one, None) is None


def test_zero_overlap_carries_nothing(one):
    text, (a, b, c) = text_of(100, 100, 100)
    assert segments(one, text, 150, 0) == [a, b, c]


def test_bad_parameters():
    with pytest.raises(ValueError):
        segment_text("c", 0)
    with pytest.raises(ValueError):
        segment_text("c", 150, -1)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("One. Two! Three? Four", ["One.", "Two!", "Three?", "Four"]),
        ("3.14 is pi.", ["3.14 is pi."]),
        ("A.\n\nB.", ["A.", "B."]),
        ("Non ! Oui.", ["Non !", "Oui."]),
        ("Fin. Puis", ["Fin.", "Puis"]),
    ],
)
def test_sentence_split(one, text, expected):
    assert one(sentence_split, text) == expected


@pytest.mark.parametrize(
    "text", ["a b", " a  b ", "", "\t", "a b c　d", "x\x1cy\x85z", "é è\r\nê"]
)
def test_word_count_is_that_of_python(one, text):
    assert one(word_count, text) == len(text.split())
    assert one(strip, text) == text.strip()


@pytest.mark.parametrize("limit, overlap", [(150, 2), (10, 1), (5, 3), (30, 0), (1, 2)])
def test_random_texts_against_brute_force(spark, limit, overlap):
    rng = random.Random(limit * 10 + overlap)
    texts = [
        " ".join(sentence(rng.choice([1, 2, 3, 8, 40]), f"t{i}s{j}") for j in range(rng.randrange(30)))
        for i in range(60)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = df.select("id", segment_text("text", limit, overlap).alias("s")).collect()
    for i, got in found:
        parts = [p for p in re.split(r"(?<=[.])\s+", texts[i]) if p]
        assert got == brute(parts, limit, overlap)


def test_every_sentence_is_kept_in_order(spark):
    docs = table(spark, "documents").select(
        sentence_split("text").alias("parts"), segment_text("text").alias("segments")
    )
    for parts, found in docs.collect():
        at = 0
        for part in parts:
            while part not in found[at]:
                at += 1
        assert at < len(found) or not parts


def test_rows_and_counts(spark):
    text, _ = text_of(100, 60)
    df = with_segments(spark.createDataFrame([(1, text), (2, "")], "id int, text string"))
    assert [tuple(r)[:2] for r in explode_segments(df, "id").collect()] == [(1, 0), (1, 1)]
    outer = explode_segments(df, "id", keep_empty=True).filter("id = 2").collect()
    assert [tuple(r) for r in outer] == [(2, None, None)]
    assert {tuple(r) for r in segment_counts(df, "id").collect()} == {(1, 2), (2, 0)}


def test_one_long_text(spark):
    text = " ".join(sentence(7, f"w{i}") for i in range(20_000))
    df = spark.createDataFrame([(text,)], "text string")
    found = df.select(segment_text("text").alias("s"))
    n, last = found.select(F.size("s"), F.element_at("s", -1)).first()
    assert n == len(brute(re.split(r"(?<=[.])\s+", text), 150, 2))
    assert last.endswith("w19999.")
