"""The inverted file of vectors: recall, rows read, filters, loads."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagevane.operators import CellSearch, append_cells, train_cells
from pagevane.operators.cells import PROBES
from pagevane.plans import catalog

from .conftest import DATA, plan_of, table
from .test_search import as_queries, brute, ranked, recall

K = 10


@pytest.fixture(scope="module")
def grouped(spark):
    """Vectors in groups, as texts of a site give; a third of them in one group."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(120, 32))
    group = np.where(np.arange(9000) % 3 == 0, 0, rng.integers(0, 120, 9000))
    points = centres[group] + 0.25 * rng.normal(size=(9000, 32))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    rows = [(i, p.tolist(), int(g) % 4) for i, (p, g) in enumerate(zip(points, rng.integers(0, 8, 9000)))]
    return spark.createDataFrame(rows, "vec_id int, embedding array<float>, label int").cache()


@pytest.fixture(scope="module")
def index(spark, grouped, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cells"))
    model = train_cells(grouped, "vec_id", sample=4000)
    for load in range(3):
        append_cells(grouped.filter(F.col("vec_id") % 3 == load), path, model, load, "vec_id", filter_on="label")
    return CellSearch(spark, path, model, grouped.schema, filter_on="label")


def test_recall_while_few_rows_are_read(grouped, index):
    queries = grouped.filter("vec_id % 100 = 1")
    exact = brute(grouped.collect(), queries.collect(), K)
    found = index.found(as_queries(queries), K)
    got, how = recall(ranked(found), exact), dict(query_id="query_id", query_vector="query_vector", match_on=None, n=PROBES)
    share = index.share_read(as_queries(queries), **how)
    print("recall", got, "share read", share)
    assert got >= 0.9 and share < 0.2


def test_recall_with_a_filter(grouped, index):
    queries = grouped.filter("vec_id % 100 = 1")
    exact = brute(grouped.collect(), queries.collect(), K, same_label=True)
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"), "label")
    found = index.found(asked, K, match_on="label")
    got, how = recall(ranked(found), exact), dict(query_id="query_id", query_vector="query_vector", match_on="label", n=PROBES)
    share = index.share_read(asked, **how)
    print("filtered recall", got, "share read", share)
    assert got >= 0.9 and share < 0.2


def test_all_cells_and_candidates_give_the_exact_result(grouped, index):
    queries = grouped.filter("vec_id % 500 = 1")
    exact = brute(grouped.collect(), queries.collect(), K)
    assert ranked(index.found(as_queries(queries), K, probes=64, refine=10**6)) == exact


def test_many_queries_take_the_other_join(grouped, index):
    queries = as_queries(grouped.filter("vec_id % 100 = 1"))
    few = ranked(index.found(queries, K, probes=3))
    assert ranked(index.found(queries, K, probes=3, small_bytes=1)) == few


def test_only_folders_of_probed_cells_are_read(grouped, index):
    found = index.found(as_queries(grouped.filter("vec_id = 1")), K, probes=2)
    filters = plan_of(found).split("PartitionFilters: [")[1].split("]")[0]
    assert "cell" in filters


def test_cells_without_the_value_are_skipped(spark, tmp_path):
    """One cell holds all rows of the value, far from the query: it is found with a single probe."""
    rng = np.random.default_rng(2)
    near = rng.normal([1, 0, 0, 0], 0.05, size=(300, 4))
    far = rng.normal([-1, 0, 0, 0], 0.05, size=(300, 4))
    points = np.concatenate([near, far])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    rows = [(i, p.tolist(), "a" if i < 300 else "b") for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, site string")
    model = train_cells(df, "vec_id", cells=6)
    append_cells(df, str(tmp_path), model, "x", "vec_id", filter_on="site")
    search = CellSearch(spark, str(tmp_path), model, df.schema, filter_on="site")
    asked = spark.createDataFrame([(0, [1.0, 0.0, 0.0, 0.0], "b")], "query_id int, query_vector array<double>, site string")
    found = search.found(asked, 5, match_on="site", probes=1).collect()
    assert len(found) == 5 and all(r["vec_id"] >= 300 for r in found)


def test_a_replayed_load_replaces_itself_and_nulls_stay_out(spark, tmp_path):
    df = table(spark, "embeddings").select("vec_id", "embedding")
    odd = df.union(spark.createDataFrame([(-1, None)], df.schema))
    model = train_cells(odd, "vec_id", cells=8)
    for _ in range(2):
        append_cells(odd, str(tmp_path), model, 0, "vec_id")
    search = CellSearch(spark, str(tmp_path), model, df.schema)
    assert search.rows.count() == df.count()
    assert search.counts().agg(F.sum("n")).first()[0] == df.count()
    with pytest.raises(Exception, match="lengths"):
        append_cells(spark.createDataFrame([(1, [1.0])], df.schema), str(tmp_path), model, 1, "vec_id")


def test_an_empty_table(spark, tmp_path):
    df = table(spark, "embeddings").select("vec_id", "embedding")
    model = train_cells(df, "vec_id", cells=4)
    append_cells(df.limit(0), str(tmp_path), model, 0, "vec_id")
    search = CellSearch(spark, str(tmp_path), model, df.schema)
    assert search.found(as_queries(df.limit(3)), K).count() == 0


def test_the_queries_find_most_of_the_exact_result(spark):
    folder = f"{DATA}/sf0.1"
    for about, exactly in (("knn_cells", "knn_exact"), ("knn_cells_filtered", "knn_filtered")):
        exact = ranked(catalog.QUERIES[exactly](spark, folder))
        assert recall(ranked(catalog.QUERIES[about](spark, folder)), exact) >= 0.9
