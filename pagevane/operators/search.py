"""Keyword lookup and full text over the index."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagevane.functions.text import tokens
from pagevane.operators.extract import compute_once
from pagevane.operators.nearest import SCORE_DECIMALS, top_k

# BM25 constants (Robertson and Zaragoza, 2009).
K1, B = 1.2, 0.75
# Query strings scored in one scan.
QUERIES_PER_PASS = 32


def keyword_lookup(
    index: DataFrame, values: Sequence[str] | DataFrame, field: str = "url"
) -> DataFrame:
    """Rows whose keyword field equals one of the values.

    A list becomes a filter that reaches the Parquet scan; a DataFrame of values a
    join, whose strategy Spark picks from the sizes it sees.
    """
    if isinstance(values, DataFrame):
        keys = values.select(F.col(values.columns[0]).alias(field)).distinct()
        # The keys are distinct. A semi join would be pushed below the columns' expressions, and
        # move the texts that they are made of.
        return index.join(keys, field).select(*index.columns)
    return index.filter(F.col(field).isin(*values))


def postings(df: DataFrame, key: str, text: str = "h1") -> DataFrame:
    """Inverted index of an analysed text field: ``term, key, tf, doc_len``."""
    analysed = df.select(key, F.inline(F.array(F.struct(tokens(text).alias("terms")))))
    return (
        analysed.select(key, F.size("terms").alias("doc_len"), F.explode("terms").alias("term"))
        .groupBy(key, "term", "doc_len")
        .agg(F.count("*").alias("tf"))
        .select("term", key, "tf", "doc_len")
    )


def query_terms(text: str) -> list[str]:
    """Terms of a query string, by the rule of ``functions.text.tokens``."""
    return re.findall(r"[^\W_]+", text.lower())


def bm25_search(
    df: DataFrame,
    queries: dict[str, str],
    key: str,
    text: str = "h1",
    k: int = 10,
) -> DataFrame:
    """The k best rows per query string by BM25: ``query_id, key, score, rank``.

    Two scans of the text column: one counts rows, lengths and the rows that hold
    each term (one row per task leaves it), one scores each row in place. Only the
    best k rows per task and query are shuffled, however common a term is. Many
    queries are answered in several passes.
    """
    terms = {q: list(dict.fromkeys(query_terms(words))) for q, words in queries.items()}
    names = list(queries)
    passes = [names[i : i + QUERIES_PER_PASS] for i in range(0, len(names), QUERIES_PER_PASS)]
    analysed = df.select(key, F.inline(F.array(F.struct(tokens(text).alias("terms")))))
    scored = [_bm25_scores(analysed, {q: terms[q] for q in some}, key) for some in passes]
    return top_k(reduce(DataFrame.union, scored), "query_id", key, k)


def _occurrences(term: str) -> Column:
    return F.size(F.filter("terms", lambda t: t == term))


def _bm25_scores(analysed: DataFrame, terms: dict[str, list[str]], key: str) -> DataFrame:
    """Score of every row that holds a term of a query."""
    wanted = sorted({t for found in terms.values() for t in found})
    # One row of numbers; as literals they keep the scoring plan small.
    n, avg_len, *in_docs = analysed.agg(
        F.count("*"),
        F.avg(F.size("terms")),
        *[F.count_if(F.array_contains("terms", t)) for t in wanted],
    ).first()
    if not n:
        return analysed.select(F.lit("").alias("query_id"), key, F.lit(0.0).alias("score"))
    idf = [math.log(1.0 + (n - df + 0.5) / (df + 0.5)) for df in in_docs]

    def part(term: str) -> Column:
        i = wanted.index(term)
        tf = F.col("tf")[i].cast("double")
        return F.lit(idf[i]) * tf * (K1 + 1) / (tf + F.lit(K1) * F.col("length"))

    length = F.lit(1 - B) + F.lit(B) * F.size("terms") / (avg_len or 1.0)
    counts = [_occurrences(t) for t in wanted]
    counted = compute_once(analysed, tf=F.array(*counts), length=length)
    scores = [
        F.struct(
            F.lit(q).alias("query_id"),
            F.round(reduce(add, map(part, found), F.lit(0.0)), SCORE_DECIMALS).alias("score"),
        )
        for q, found in terms.items()
    ]
    # Inlined straight from the array expression: an array column would be computed
    # a second time, to see whether it is empty.
    per_query = counted.select(F.inline(F.array(*scores)), key)
    return per_query.filter("score > 0").select("query_id", key, "score")
