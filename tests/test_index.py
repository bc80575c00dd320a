from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pagevane.operators import index_batches, keyword_lookup
from pagevane.plans.stages import Settings, build_index, embed_step, index_step
from pagevane.sinks import (
    append_index,
    batch_path,
    checked_path,
    create_index,
    index_dim,
    index_exists,
    read_index,
    read_rejected,
)

from .conftest import plan_of, table


def vectors(spark, n=20):
    return spark.range(n).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"),
        F.lit("t").alias("h1"),
        F.array(F.lit(1.0), F.lit(0.0)).alias("embedding"),
    )


def test_create_if_absent(spark, tmp_path):
    path = str(tmp_path / "index")
    assert not index_exists(spark, path)
    assert create_index(spark, path, 2) is True
    assert create_index(spark, path, 5) is False
    assert index_exists(spark, path) and index_dim(spark, path) == 2
    assert read_index(spark, path).count() == 0


def test_append_and_replay(spark, tmp_path):
    path = str(tmp_path / "index")
    settings = Settings(dim=2)
    index_step(vectors(spark), path, 0, settings)
    index_step(vectors(spark), path, 1, settings)
    assert read_index(spark, path).count() == 40
    index_step(vectors(spark), path, 1, settings)
    assert read_index(spark, path).count() == 40
    assert read_index(spark, path).schema.fieldNames() == ["url", "h1", "embedding", "load"]


def test_other_dimension_is_refused(spark, tmp_path):
    path = str(tmp_path / "index")
    create_index(spark, path, 3)
    with pytest.raises(ValueError, match="dimension 3"):
        index_step(vectors(spark), path, 0, Settings(dim=2))


def test_same_url_twice_is_two_documents(spark, tmp_path):
    path = str(tmp_path / "index")
    twice = vectors(spark, 3).unionAll(vectors(spark, 3))
    append_index(twice, path, 0)
    found = keyword_lookup(read_index(spark, path), ["u1"])
    assert found.count() == 2
    assert "In(url" in plan_of(found) or "EqualTo(url" in plan_of(found)


@pytest.mark.parametrize("n, size, bucket", [(1000, 128, 200), (1000, 1000, 100), (7, 10, 2), (0, 10, 5)])
def test_batches_are_exact(spark, n, size, bucket):
    batched = index_batches(spark.range(n), "id", size, bucket)
    counts = {r.batch: r["count"] for r in batched.groupBy("batch").count().collect()}
    assert sum(counts.values()) == n
    assert sorted(counts) == list(range(-(-n // size)))
    assert all(c == size for b, c in counts.items() if b != max(counts))
    assert batched.columns == ["id", "batch"]


def test_build_index_from_pages(spark, tmp_path):
    pages = table(spark, "pages", "sf0.01")
    index, work = str(tmp_path / "index"), str(tmp_path / "work")
    load = build_index(spark, pages, index, work, "first")
    texts = spark.read.parquet(checked_path(f"{work}/texts"))
    assert load.count() == texts.count() > 0
    assert read_index(spark, index).filter("size(embedding) = 384").count() == load.count()
    assert {r.url for r in load.collect()} == {r.url for r in texts.collect()}
    again = build_index(spark, pages, index, work, "first")
    assert again.count() == read_index(spark, index).count()


def test_embed_step_sets_bad_rows_aside(spark, tmp_path):
    out = str(tmp_path / "vectors")
    rows = [("u1", "t", "Un. Deux."), ("u2", None, "Un."), ("u3", "t", "..."), ("u4", "t", "  ")]
    embed_step(spark.createDataFrame(rows, "url string, h1 string, text string"), out, 0)
    whole = spark.read.parquet(batch_path(out, 0))
    reasons = {r.url: (r.status, r._error) for r in whole.collect()}
    assert reasons == {
        "u1": ("ok", None),
        "u2": ("bad", "missing h1"),
        "u3": ("ok", None),
        "u4": ("bad", "no segments"),
    }
    wrong = str(tmp_path / "wrong")
    texts = spark.createDataFrame(rows[:1], "url string, h1 string, text string")
    embed_step(texts, wrong, 0, Settings(dim=7))
    assert spark.read.parquet(batch_path(wrong, 0)).first()._error == "wrong dimension"


def test_two_loads_are_both_kept(spark, tmp_path):
    index, work = str(tmp_path / "index"), str(tmp_path / "work")
    pages = spark.createDataFrame(
        [(f"u{i}", "<html><h1>t</h1><p>Les mots que nous avons dans la maison sont pour vous.</p></html>") for i in range(7)],
        "url string, html string",
    )
    some, rest = pages.filter("url < 'u4'"), pages.filter("url >= 'u4'")
    build_index(spark, some, index, work, "one")
    build_index(spark, rest, index, work, "two")
    assert read_index(spark, index).count() == 7
    with pytest.raises(TypeError):
        build_index(spark, some, index, work)


def test_streams_into_one_index_keep_their_loads(spark, tmp_path):
    from pagevane.operators.messages import INDEX_SCHEMA
    from pagevane.streaming import index_job

    index = str(tmp_path / "index")
    for name in "ab":
        queue = str(tmp_path / name)
        rows = [(name, "t", [1.0, 0.0])]
        spark.createDataFrame(rows, INDEX_SCHEMA).write.parquet(queue)
        stream = spark.readStream.schema(INDEX_SCHEMA).parquet(queue)
        job = index_job(stream, index, Settings(dim=2), checkpoint=str(tmp_path / f"c{name}"), drain=True)
        job.awaitTermination()
    assert sorted(r.url for r in read_index(spark, index).collect()) == ["a", "b"]


def test_bad_messages_are_not_indexed(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = [
        ("good", "t", [1.0, 2.0], None),
        ("bad json", None, None, "corrupt"),
        (None, "t", [1.0, 2.0], None),
        ("long", "t", [1.0, 2.0, 3.0], None),
        ("null", "t", [1.0, None], None),
    ]
    messages = spark.createDataFrame(rows, "url string, h1 string, embedding array<float>, _error string")
    index_step(messages, path, "load", Settings(dim=2))
    assert [r.url for r in read_index(spark, path).collect()] == ["good"]
    reasons = {r.url: r._error for r in read_rejected(spark, path).collect()}
    assert reasons == {
        "bad json": "corrupt",
        None: "missing url",
        "long": "wrong dimension",
        "null": "null in vector",
    }


def test_batches_hold_null_keys_too(spark):
    rows = spark.createDataFrame([(1,), (None,), (2,)], "id long")
    assert sorted(r.batch for r in index_batches(rows, "id", 2, 2).collect()) == [0, 0, 1]


def test_a_cluster_must_name_the_shared_folder(spark, monkeypatch):
    from pagevane import session

    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_dir(spark)


def test_loads_that_overlap_index_each_message_once(spark, tmp_path):
    pages = table(spark, "pages")
    index, work = str(tmp_path / "index"), str(tmp_path / "work")
    once = Settings(index_once=True)
    some, more = pages.filter("page_id < 30"), pages.filter("page_id >= 10")
    build_index(spark, some, index, work, "one", once)
    build_index(spark, more.union(more.limit(20)), index, work, "two", once)
    whole = str(tmp_path / "whole")
    build_index(spark, pages, whole, str(tmp_path / "work2"), "all")
    want = sorted((r.url, r.h1) for r in read_index(spark, whole).collect())
    assert sorted((r.url, r.h1) for r in read_index(spark, index).collect()) == want
    # Each run again: the same rows, in the same loads.
    before = sorted((r.url, r.load) for r in read_index(spark, index).collect())
    build_index(spark, some, index, work, "one", once)
    build_index(spark, more, index, work, "two", once)
    assert sorted((r.url, r.load) for r in read_index(spark, index).collect()) == before


def test_one_message_very_often_is_indexed_once(spark, tmp_path):
    path = str(tmp_path / "index")
    settings = Settings(dim=2, index_once=True)
    many = spark.range(5000).select(F.lit("u").alias("url"), F.lit("t").alias("h1"), F.array(F.lit(1.0), F.lit(0.0)).alias("embedding"))
    index_step(many, path, "a", settings)
    index_step(many, path, "b", settings)
    assert read_index(spark, path).count() == 1
