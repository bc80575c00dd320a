from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagevane.functions import detect_lang
from pagevane.operators import (
    classify_ngrams,
    corpus_profile,
    language_filter,
    train_language_model,
    train_ngram_profiles,
    with_modelled_language,
)
from pagevane.operators import langmodel as M
from pagevane.operators import language as N

from .conftest import plan_of, table


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Le chat est dans la maison et les enfants", "fr"),
        ("The cat is in the house and the children", "en"),
        ("Die Katze ist nicht von dem Haus", "de"),
        ("Los gatos y las casas por el camino", "es"),
        ("12345 !!!", "und"),
        ("", "und"),
        ("LE LA LES", "fr"),
        ("de", "es"),
    ],
)
def test_vote(one, text, expected):
    assert one(detect_lang, text) == expected


def test_precision_on_labelled_documents(spark):
    docs = table(spark, "documents", "sf0.01").select("lang", detect_lang("text").alias("found"))
    french = docs.filter("found = 'fr'")
    assert french.filter("lang = 'fr'").count() / french.count() >= 0.95
    assert docs.filter("found = lang").count() / docs.count() >= 0.97


def test_ngrams_agree_with_labels(spark):
    docs = table(spark, "documents", "sf0.01")
    found = classify_ngrams(docs, train_ngram_profiles(docs), "doc_id")
    assert found.count() == docs.count()
    right = found.join(docs, "doc_id").filter("detected = lang").count()
    assert right / docs.count() >= 0.97


def test_ngrams_of_nothing_are_undetermined(spark):
    docs = table(spark, "documents")
    odd = spark.createDataFrame([(1, "123"), (2, ""), (3, "и")], "doc_id int, text string")
    found = classify_ngrams(odd, train_ngram_profiles(docs), "doc_id").collect()
    assert {(r.doc_id, r.detected, r.n_matched) for r in found} == {
        (1, "und", 0),
        (2, "und", 0),
        (3, "und", 0),
    }


def test_profiles_hold_every_ngram(spark):
    docs = table(spark, "documents")
    words = docs.select(F.explode(F.split(F.lower("text"), N.NON_LETTERS)).alias("w")).filter("w <> ''").distinct()
    grams = {f" {r.w} "[i : i + N.GRAM] for r in words.collect() for i in range(max(len(r.w), 1))}
    plan = train_ngram_profiles(docs)
    assert {r.gram for r in plan.collect()} == grams
    assert "Window" not in plan_of(plan)


def test_ngrams_on_texts_that_were_not_trained_on(spark, tmp_path):
    docs = table(spark, "documents", "sf0.01")
    train_ngram_profiles(docs.filter("doc_id % 2 = 0")).write.parquet(str(tmp_path / "profiles"))
    profiles = spark.read.parquet(str(tmp_path / "profiles"))
    found = classify_ngrams(docs.filter("doc_id % 2 = 1"), profiles, "doc_id").join(docs, "doc_id")
    right = found.filter("detected = lang").count()
    assert right > 0.97 * found.count()


def test_ngrams_of_texts_are_not_shuffled(spark, tmp_path):
    docs = table(spark, "documents")
    train_ngram_profiles(docs).write.parquet(str(tmp_path / "profiles"))
    plan = plan_of(classify_ngrams(docs, spark.read.parquet(str(tmp_path / "profiles")), "doc_id"))
    assert plan.count("Exchange hashpartitioning") == 1  # the sums of each key


def test_rare_ngrams_are_joined_apart_with_the_same_result(spark):
    docs = table(spark, "documents").select("doc_id", "text", "lang")
    odd = spark.createDataFrame(
        [(None, "le chat"), (None, "und so weiter"), (1, "le chat und"), (-1, ""), (-2, None), (-3, "xqzk жжж")],
        "doc_id long, text string",
    )
    rows = docs.drop("lang").union(odd).union(docs.drop("lang").limit(5))
    profiles = train_ngram_profiles(docs)
    whole = sorted(map(repr, classify_ngrams(rows, profiles, "doc_id").collect()))
    assert len(whole) == docs.count() + 3
    for frequent in (1, 300):
        assert sorted(map(repr, classify_ngrams(rows, profiles, "doc_id", frequent=frequent).collect())) == whole


def test_model_on_texts_that_were_not_trained_on(spark):
    docs = table(spark, "documents", "sf0.01")
    model = train_language_model(docs.filter("doc_id % 2 = 0"), F.col("doc_id") % 10 == 0)
    found = with_modelled_language(docs.filter("doc_id % 2 = 1"), model)
    n = found.count()
    sure = found.filter("detected <> 'und'")
    assert sure.count() > 0.98 * n
    assert sure.filter("detected = lang").count() > 0.99 * sure.count()
    assert model.weights.shape == (M.BINS, len(model.languages))


def test_model_rejects_what_it_does_not_know(spark):
    docs = table(spark, "documents")
    model = train_language_model(docs, F.col("doc_id") % 5 == 0)
    texts = ["", None, "123 !", "и не то что", "漢字", "une maison pour les enfants", "a"]
    odd = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = {r.id: r for r in with_modelled_language(odd, model).collect()}
    assert [found[i].detected for i in range(4)] == ["und"] * 4
    assert found[4].detected == "und" and found[5].detected == "fr"
    assert [found[i].n_known for i in range(3)] == [0, 0, 0]


def test_model_of_nothing_rejects_all(spark):
    none = spark.createDataFrame([], "id int, text string, lang string")
    model = train_language_model(none, F.lit(False))
    docs = table(spark, "documents")
    assert {r.detected for r in with_modelled_language(docs, model).select("detected").collect()} == {"und"}


def test_model_scores_without_a_shuffle(spark):
    docs = table(spark, "documents")
    model = train_language_model(docs, F.col("doc_id") % 5 == 0)
    plan = plan_of(with_modelled_language(docs, model))
    assert "Exchange" not in plan and "Join" not in plan


def test_pieces_of_a_long_text_give_the_same_bins(monkeypatch):
    text = " " + "ab cdé fgh " * 40
    whole = np.concatenate(list(M._bins(text, M.BINS)))
    assert len(whole) == len(text) - 2
    monkeypatch.setattr(M, "CHARACTERS", 7)
    assert (np.concatenate(list(M._bins(text, M.BINS))) == whole).all()


def test_filter_and_profile(spark):
    docs = table(spark, "documents")
    kept = language_filter(docs)
    assert {r.detected for r in kept.select("detected").collect()} == {"fr"}
    counted = docs.select(detect_lang("text").alias("detected"), F.lit(1).alias("n_segments"))
    profile = {r.detected: r for r in corpus_profile(counted).collect()}
    assert profile["total"].n_docs == docs.count()
    assert profile["fr"].n_dropped == 0 and profile["en"].n_kept == 0
    assert profile["total"].n_kept == kept.count()
