from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagevane.functions import dot, l2_norm, l2_normalize, segment_text, token_code
from pagevane.operators import (
    HashingEncoder,
    dim_check,
    document_embeddings,
    embed_documents,
    embed_segments,
    encode_segments,
    hash_encode,
    mean_pool,
)
from pagevane.operators.embed import _token_code

from .conftest import plan_of, table


class LengthEncoder:
    """Plug-in with three dimensions, to see what an encoder is given."""

    def __call__(self, texts):
        return np.array([[len(t), 1.0, -float(len(t) == 0)] for t in texts])


def vectors(spark, rows):
    return spark.createDataFrame(rows, "k string, embedding array<float>")


def test_token_code_has_one_rule(spark):
    words = ["a", "le", "été", "straße", "日本", "x1"]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    found = {r.t: r.c for r in df.select("t", token_code("t").alias("c")).collect()}
    assert found == {w: _token_code(w, 384) for w in words}


def test_encoder_equals_sparse_expressions(spark):
    texts = ["Le chat dort. Le chat!", "", "...", "un deux trois", "É é"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, segment string")
    dense = np.zeros((len(texts), 384))
    for r in hash_encode(df, "id").collect():
        dense[r.id, r.bucket] = r.weight
    assert np.allclose(HashingEncoder()(texts), dense, atol=1e-12)
    norms = np.linalg.norm(dense, axis=1)
    assert np.allclose(norms, [1, 0, 0, 1, 1])


def test_document_vector_is_mean_of_unit_segments(spark):
    docs = table(spark, "documents").select("doc_id", "text")
    segments = {r.doc_id: r.s for r in docs.select("doc_id", segment_text("text").alias("s")).collect()}
    encode = HashingEncoder()
    for r in embed_documents(docs).collect():
        mean = encode(segments[r.doc_id]).mean(axis=0)
        expected = mean / max(np.linalg.norm(mean), 1e-12)
        assert np.allclose(r.embedding, expected, atol=1e-6)
        norm = np.linalg.norm(r.embedding)
        assert norm == 0 or abs(norm - 1) < 1e-5


def test_no_segments_no_vector(spark):
    df = spark.createDataFrame([(1, ""), (2, "Oui."), (3, None)], "id int, text string")
    found = {r.id: r.embedding for r in embed_documents(df).collect()}
    assert found[1] is None and found[3] is None and len(found[2]) == 384


def test_plug_in_encoder_and_batches(spark):
    rows = [(i, ["x" * (i % 5), "yy"][: 1 + i % 2]) for i in range(100)] + [(100, [])]
    df = spark.createDataFrame(rows, "id int, segments array<string>").repartition(3)
    found = df.select("id", embed_segments("segments", LengthEncoder, 7).alias("v")).collect()
    for i, v in found:
        if i == 100:
            assert v is None
            continue
        mean = LengthEncoder()(rows[i][1]).mean(axis=0)
        assert np.allclose(v, mean / np.linalg.norm(mean), atol=1e-6)


def test_encode_segments_keeps_rows(spark):
    df = spark.createDataFrame([(i, "z" * i) for i in range(20)], "id int, segment string")
    found = encode_segments(df, LengthEncoder, batch_size=3).collect()
    assert {(r.id, r.embedding[0]) for r in found} == {(i, float(i)) for i in range(20)}


def test_encoder_runs_once_under_filters(spark):
    docs = table(spark, "documents").select("doc_id", "text")
    checked = dim_check(embed_documents(docs)).filter("dim_ok").filter("embedding[0] <> 0")
    plan = plan_of(checked.select("doc_id", F.explode("embedding")))
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan


def test_hash_encode_shuffles_once(spark):
    df = spark.createDataFrame([(1, 0, "a b")], "id int, seg_no int, segment string")
    assert plan_of(hash_encode(df, "id", "seg_no")).count("Exchange") == 1


def test_hash_encode_tasks_are_not_put_together(spark):
    rows = [(i % 40, f"mot{i} mot{i % 7} le") for i in range(200)] + [(None, "a b"), (None, "b c")]
    df = spark.createDataFrame(rows, "id int, segment string").repartition(2)
    every = hash_encode(df, "id", partitions=29)
    assert every.rdd.getNumPartitions() == 29
    default = hash_encode(df, "id")
    assert default.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(repr, every.collect())) == sorted(map(repr, default.collect()))


def test_pool_of_cancelling_vectors_is_zero(spark):
    df = vectors(spark, [("a", [1.0, 0.0]), ("a", [-1.0, 0.0]), ("b", [3.0, 4.0])])
    found = {r.k: r.embedding for r in document_embeddings(df, "k").collect()}
    assert found["a"] == [0.0, 0.0]
    assert np.allclose(found["b"], [0.6, 0.8])


def test_hot_key_is_folded_before_the_shuffle(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("embedding"),
    )
    pooled = mean_pool(df, "k")
    assert "partial_" in plan_of(pooled)
    hot = pooled.filter("k = 'hot'").first()
    assert np.allclose(hot["mean"], [np.arange(0, 30_000, 3).mean(), 1.0])


def test_dim_check(spark):
    df = vectors(spark, [("a", [1.0, 2.0]), ("b", [1.0]), ("c", None)])
    assert {r.k: r.dim_ok for r in dim_check(df, 2).collect()} == {"a": True, "b": False, "c": False}


def test_vector_functions(spark):
    df = vectors(spark, [("a", [3.0, 4.0]), ("z", [0.0, 0.0])])
    rows = df.select("k", l2_norm("embedding"), l2_normalize("embedding"), dot("embedding", "embedding"))
    found = {r[0]: tuple(r)[1:] for r in rows.collect()}
    assert found["a"] == (5.0, [0.6, 0.8], 25.0)
    assert found["z"] == (0.0, [0.0, 0.0], 0.0)


@pytest.mark.parametrize("texts", [[], [""]])
def test_encoder_of_nothing(texts):
    assert HashingEncoder(8)(texts).shape == (len(texts), 8)
