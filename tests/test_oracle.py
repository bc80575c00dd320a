"""Every registered query against its SQL in DuckDB, on whole tables."""

from __future__ import annotations

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry
from pagevane.plans import catalog, oracle

from .conftest import DATA, ROOT

SF = f"{DATA}/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = df.collect()
    expected = duck.execute(ORACLE[name])
    names = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, found) == rows(names, expected.fetchall())
    assert found


def test_every_query_but_approximate_search_has_sql():
    own = set(catalog.QUERIES)
    assert own - set(oracle.oracle_sql()) == {"knn_lsh", "knn_cells", "knn_cells_filtered"}
    assert set(ORACLE) <= set(QUERIES)


def test_entry_has_rows_and_columns(spark):
    df = entry.entry(spark)
    assert df.columns == ["page_id", "url", "h1", "text"]
    assert df.count() > 0


def test_results_do_not_depend_on_partitioning(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    names = ["embed_documents", "detect_lang_ngram", "knn_exact", "index_batches"]
    first = {n: rows(*_read(spark, n)) for n in names}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert {n: rows(*_read(spark, n)) for n in names} == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _read(spark, name):
    df = QUERIES[name](spark, SF)
    return df.columns, df.collect()


def test_repository_holds_no_data():
    import os

    for folder, _, files in os.walk(ROOT):
        if ".git" in folder.split(os.sep):
            continue
        assert not [f for f in files if f.endswith((".parquet", ".warc.gz"))], folder
