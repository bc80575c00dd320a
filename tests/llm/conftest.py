from __future__ import annotations

import pytest

# Columns whose names the operators use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, `key` string, row string, "
    "n int, twin long, node long, component long, judged double, place int, start int, site string"
)
LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(30_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))


def odd_rows() -> list[tuple]:
    """Nulls, empty and blank texts, repeated rows and ids, ties, a very long text."""
    base = "The quick brown fox jumps over the lazy dog near the old river bank today\nsecond line here"
    texts = [
        (0, base),
        (1, base),
        (1, base),
        (2, base.upper()),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, "one two"),
        (7, "one two"),
        (8, LONG),
        (9, LONG + " tail"),
        (10, f"intro words {PASSAGE} end"),
        (11, f"other start {PASSAGE} and more of it"),
        (11, "same id another text with five words"),
        (12, "éèê ça  va\xa0bien 漢字 🙂 x@y.zz +1 (212) 555-0100 and 1.2.3.4"),
        (None, base),
        (None, None),
    ]
    return [
        (i, t, "en", f"src{n % 3}" if n != 5 else None, len(t or ""), 7, "k", "r", 1, 2, 3, 4, 0.5, 6, 8, "s")
        for n, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
