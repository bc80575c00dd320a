"""A corpus from raw documents to packed sequences, stage by stage.

``STAGES`` lists the stages in order. Each takes the session, the documents its predecessor
kept, and the data folder; ``run`` writes what a stage returns as Parquet in the shared folder
and reads it again as the next one's documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagevane.llm import jaccard, lines, packing, personal, toxicity
from pagevane.llm.common import fresh, small_batches, table
from pagevane.session import shared_dir, ship_package

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)
    small_batches(spark)


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with another text, and the number of its characters where they are counted."""
    docs = docs.withColumn("text", text)
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity score is below 0.5; a null or empty text is scored as empty."""
    _prepare(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    judged = fresh(docs, "judged")
    return docs.withColumn(judged, toxicity.judged(docs, model)).filter(F.col(judged)["score"] < 0.5).drop(judged)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sites share but at a line's first place.

    A document that consists of such lines stays, with an empty text.
    """
    _prepare(spark)
    found = lines.without_boilerplate(docs)
    kept = found.select(F.col("row").withField("text", F.when(F.col("row.text").isNotNull(), F.col("kept"))).alias("row"))
    return _with_text(kept.select("row.*"), F.col("text"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id, and all other documents.

    Rows that share an id are one document, of which one row stays. Rows with a null id stay.
    """
    _prepare(spark)
    found = jaccard.jaccard_components(docs)
    keep = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    place = fresh(docs, "place")
    first = W.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    rows = docs.join(keep, "doc_id", "left_semi").withColumn(place, F.row_number().over(first))
    rows = rows.filter(F.col(place) == 1).drop(place).select(*docs.columns)
    return rows.union(docs.filter("doc_id is null"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets."""
    _prepare(spark)
    weights = personal.fit(docs)
    return _with_text(docs, personal.mask(F.col("text"), weights))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes among the sequences."""
    _prepare(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), CAPACITY)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_boilerplate),
    ("ngram_jaccard", one_of_each_group),
    ("personal_data", mask_personal),
    ("best_fit_packing", pack),
]

# Scores of a fitted model, tokenizer ids and the packing plan can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are stored in the shared folder."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
