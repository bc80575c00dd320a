from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagevane.operators import (
    bm25_search,
    keyword_lookup,
    knn_exact,
    knn_lsh,
    knn_single,
    lsh_index,
    lsh_model,
    postings,
)

from .conftest import plan_of, table


def as_queries(df):
    return df.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))


def brute(corpus, queries, k, same_label=False):
    """Ids of the k best rows per query."""
    ids = np.array([r.vec_id for r in corpus])
    matrix = np.array([r.embedding for r in corpus], dtype=float)
    out = {}
    for q in queries:
        scores = np.round(matrix @ np.array(q.embedding, dtype=float), 9)
        if same_label:
            scores = np.where([r.label == q.label for r in corpus], scores, -np.inf)
        order = np.lexsort((ids, -scores))
        out[q.vec_id] = [int(ids[i]) for i in order[:k] if np.isfinite(scores[i])]
    return out


def ranked(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


@pytest.fixture(scope="module")
def vectors(spark):
    return table(spark, "embeddings").repartition(5, "vec_id").cache()


def test_all_vectors_against_brute_force(spark, vectors):
    rows = vectors.collect()
    found = knn_exact(vectors, as_queries(vectors), 7)
    expected = brute(rows, rows, 7)
    assert ranked(found) == expected
    assert all(ids[0] == q for q, ids in expected.items())


def test_query_sets_above_the_bound_are_dealt_with_the_corpus(vectors):
    queries = vectors.filter("label < 5")
    found = knn_exact(vectors, as_queries(queries), 3, max_queries=60)
    assert ranked(found) == brute(vectors.collect(), queries.collect(), 3)


def test_filter_value_per_query(vectors):
    queries = vectors.filter("label in (1, 2)")
    asked = as_queries(queries).join(
        queries.select(F.col("vec_id").alias("query_id"), "label"), "query_id"
    )
    found = knn_exact(vectors, asked, 200, match_on="label")
    assert ranked(found) == brute(vectors.collect(), queries.collect(), 200, same_label=True)


def test_plain_filter_before_search(vectors):
    query = vectors.first()
    found = knn_single(vectors.filter("label = 3"), query.embedding, 5).collect()
    some = [r for r in vectors.collect() if r.label == 3]
    assert [r.vec_id for r in found] == brute(some, [query], 5)[query.vec_id]


def test_ties_go_to_the_smaller_id_and_copies_stay_whole(spark):
    rows = [(f"id{i:04d}", [1.0, 0.0] if i % 3 else [0.6, 0.8]) for i in range(3000)]
    corpus = spark.createDataFrame(rows, "vec_id string, embedding array<float>").repartition(7)
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, query_vector array<double>")
    best = knn_exact(corpus, queries, 5).orderBy("rank").collect()
    assert [r.vec_id for r in best] == ["id0001", "id0002", "id0004", "id0005", "id0007"]
    assert knn_exact(corpus, queries, 5000).count() == 3000


def test_empty_sides(spark, vectors):
    assert knn_exact(vectors, as_queries(vectors.limit(0)), 3).count() == 0
    assert knn_exact(vectors.limit(0), as_queries(vectors.limit(3)), 3).count() == 0


def test_single_query_keeps_k_rows_per_task(vectors):
    found = knn_single(vectors, vectors.first().embedding, 5)
    assert "TakeOrderedAndProject" in plan_of(found)


def test_exact_search_leaves_the_corpus_where_it_is(spark):
    """Query blocks are broadcast to the corpus; what is shuffled are best rows only, cut before."""
    vectors = table(spark, "embeddings")
    plan = plan_of(knn_exact(vectors, as_queries(vectors), 3))
    assert plan.count("BroadcastHashJoin") == 1 and "NestedLoop" not in plan and "Cartesian" not in plan
    assert "WindowGroupLimit" in plan and plan.count("Exchange hashpartitioning") == 1


def test_one_vector_asked_with_several_filters(spark, vectors):
    """What is known of one filter's best rows says nothing of another's."""
    one = vectors.orderBy("vec_id").limit(1).select("embedding").first()[0]
    asked = spark.createDataFrame([(i, one, i) for i in range(10)], "query_id int, query_vector array<double>, label int")
    found = knn_exact(vectors, asked, 4, match_on="label")
    for q in range(10):
        some = [r for r in vectors.collect() if r.label == q]
        best = sorted(some, key=lambda r: (-round(float(np.dot(r.embedding, one)), 9), r.vec_id))[:4]
        got = [r.vec_id for r in sorted(found.filter(f"query_id = {q}").collect(), key=lambda r: r["rank"])]
        assert got == [r.vec_id for r in best]


def recall(found, exact):
    return np.mean([len(set(exact[q]) & set(found.get(q, []))) / len(exact[q]) for q in exact])


def test_lsh_recall(spark):
    vectors = table(spark, "embeddings", "sf0.1")
    model = lsh_model(vectors)
    queries = vectors.filter("vec_id < 40")
    exact = brute(vectors.collect(), queries.collect(), 10)
    indexed = lsh_index(vectors.select("vec_id", "embedding"), model)
    found = ranked(knn_lsh(indexed, as_queries(queries), model, 10))
    assert recall(found, exact) >= 0.9
    several = ranked(knn_lsh(indexed, as_queries(queries), model, 10, max_queries=15))
    assert several == found


def test_lsh_on_grouped_vectors_skips_most_rows(spark):
    """Vectors in tight groups, as real texts give, unlike the random test table."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(80, 64))
    points = np.repeat(centres, 25, axis=0) + 0.15 * rng.normal(size=(2000, 64))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    vectors = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    queries = vectors.filter("vec_id % 25 = 0")
    model = lsh_model(vectors, bucket_length=0.3, per_table=8)
    indexed = lsh_index(vectors, model, per_table=8)
    exact = brute(vectors.collect(), queries.collect(), 10)
    found = ranked(knn_lsh(indexed, as_queries(queries), model, 10, per_table=8))
    assert recall(found, exact) >= 0.95
    pairs = knn_lsh(indexed, as_queries(queries), model, 2000, per_table=8).count()
    assert pairs < 0.2 * 80 * 2000


def test_lsh_pairs_are_scored_once(spark):
    rows = [(i, [1.0, 0.0]) for i in range(50)]
    same = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    model = lsh_model(same, tables=6)
    found = knn_lsh(lsh_index(same, model), as_queries(same.limit(1)), model, 100)
    assert found.count() == 50


def test_keyword_lookup(spark):
    pages = table(spark, "pages").select("page_id", "url")
    urls = [r.url for r in pages.limit(2).collect()]
    by_list = keyword_lookup(pages, [*urls, "http://no.such/"])
    assert {r.url for r in by_list.collect()} == set(urls)
    assert "PushedFilters: [In(url" in plan_of(by_list)
    twice = spark.createDataFrame([(u,) for u in urls + urls], "u string")
    assert keyword_lookup(pages, twice).count() == 2


def test_bm25_against_brute_force(spark):
    texts = ["Le chat dort", "le chat LE chien", "un oiseau", "", None, "chat-chat chat"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, h1 string")
    found = bm25_search(df, {"a": "chat", "b": "le Chien, le"}, "id").collect()
    docs = {i: [w for w in (t or "").lower().replace("-", " ").split()] for i, t in enumerate(texts)}
    lengths = [len(docs[i]) for i in docs if texts[i] is not None]
    average = sum(lengths) / len(lengths)

    def score(i, terms):
        total, tf = 0.0, Counter(docs[i])
        for t in terms:
            n = sum(t in d for d in docs.values())
            idf = math.log(1 + (len(docs) - n + 0.5) / (n + 0.5))
            total += idf * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(docs[i]) / average))
        return round(total, 9)

    for q, terms in {"a": ["chat"], "b": ["le", "chien"]}.items():
        expected = {i: score(i, terms) for i in docs if score(i, terms) > 0}
        got = {r.id: r.score for r in found if r.query_id == q}
        assert got.keys() == expected.keys()
        assert all(abs(got[i] - expected[i]) < 1e-8 for i in got)


def test_bm25_without_matches_or_rows(spark):
    df = spark.createDataFrame([(1, "un")], "id int, h1 string")
    assert bm25_search(df, {"q": "zzz"}, "id").count() == 0
    assert bm25_search(df.limit(0), {"q": "un"}, "id").count() == 0
    many = {f"q{i}": "un deux" for i in range(70)}
    assert bm25_search(df, many, "id").count() == 70


def test_postings(spark):
    df = spark.createDataFrame([(1, "a b A"), (2, "b"), (3, "")], "id int, h1 string")
    found = {tuple(r) for r in postings(df, "id").collect()}
    assert found == {("a", 1, 2, 3), ("b", 1, 1, 3), ("b", 2, 1, 1)}


def test_vectors_of_another_length_are_an_error(spark):
    from pagevane.operators import knn_exact

    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0, 0.0])], "vec_id long, embedding array<float>")
    asked = spark.createDataFrame([(1, [1.0, 0.0, 0.0])], "query_id long, query_vector array<double>")
    with pytest.raises(Exception, match="vectors of length"):
        knn_exact(vectors, asked, 1).collect()
    null = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, None)], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in knn_exact(null, asked, 5).collect()] == [1]


def test_url_lookup_joins_without_page_texts(spark):
    from pagevane.plans.catalog import url_lookup

    lines = url_lookup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().split("\n")
    (join,) = [i for i, line in enumerate(lines) if "Join Inner" in line]
    # Its side has the headings already, and nothing below them is moved.
    assert ":- Generate inline(" in lines[join + 1] and "h1" in lines[join + 1]
