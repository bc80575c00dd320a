"""The registered queries: each reads whole tables of a data folder.

The tables stand for the pipeline's data: ``pages`` are raw pages, ``documents``
text messages, ``embeddings`` index documents (``label`` groups them), ``events`` a
stream of metrics.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagevane import operators as op
from pagevane.functions import (
    extract_text,
    first_h1,
    local_key,
    main_text,
    resolve_path,
    sentence_split,
    word_count,
)
from pagevane.operators.extract import compute_once
from pagevane.session import scratch_dir
from pagevane.sinks.postings import append_postings
from pagevane.sources import spread

Query = Callable[[SparkSession, str], DataFrame]

K = 10
ROUND = 6
BATCH = 128
ROWS_PER_BUCKET = 200
# The cells of a split's segments take some 30 times its bytes.
TASKS_PER_SPLIT = 32
# Of 64 cells: the test vectors have no groups, so near ones lie in many cells.
CELL_PROBES = 48
# Loads that a table is appended to the stored postings in; together they are the whole table.
LOADS = 3
# One full-text query per language.
FULL_TEXT = {
    "q_de": "der und ein",
    "q_en": "the of that",
    "q_es": "los por una",
    "q_fr": "les que dans",
}
# The kind of event that stands for each metric step; the alias and
# an unknown step are among them.
EVENT_STEPS = {
    "view": "warc",
    "click": "vector",
    "purchase": "index",
    "signup": "index_batch_async",
    "error": "other",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return spread(docs, "doc_id")


def _rounded(c: Column | str) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), ROUND)


def _cells(df: DataFrame, vector: str, *keys: str) -> DataFrame:
    """Non-zero entries of a vector column as rows, which any engine can compare."""
    cells = df.select(*keys, F.posexplode(vector).alias("pos", "value"))
    rounded = cells.select(
        *keys, F.col("pos").cast("bigint").alias("pos"), _rounded("value").alias("value")
    )
    return rounded.filter("value <> 0")


# --- scans and projections --------------------------------------------------------


def pages_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", "html")


def resolve_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", resolve_path("url").alias("path"), local_key("url").alias("local_key")
    )


def extract_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    return pages.select("page_id", extract_text("html").alias("text"))


def extract_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    return pages.select("page_id", main_text("html").alias("text"))


def site_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir).select("page_id", "url", main_text("html").alias("text"))
    return op.drop_site_blocks(pages, "page_id").drop("url")


def first_h1_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", first_h1("html").alias("h1"))


def french_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = op.extract_pages(_pages(spark, sf_dir))
    return pages.select("page_id", "url", "h1", "text")


def encode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = op.extract_pages(_pages(spark, sf_dir))
    return op.encode_messages(pages, "url", "h1", "text")


# --- language ----------------------------------------------------------------------


def detect_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return op.with_language(docs).select("doc_id", "detected")


def detect_lang_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return op.classify_ngrams(docs, op.train_ngram_profiles(docs), "doc_id")


def detect_lang_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, by a model of four fifths of them; the last fifth sets the least margin."""
    docs = _documents(spark, sf_dir)
    model = op.train_language_model(docs, held_out=F.col("doc_id") % 5 == 0)
    return op.with_modelled_language(docs, model).select("doc_id", "detected", "margin", "n_known")


def french_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return op.language_filter(docs).select("doc_id", "source", "n_chars", "detected")


def corpus_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = op.with_segments(op.with_language(_documents(spark, sf_dir)))
    return op.corpus_profile(docs.select("detected", F.size("segments").alias("n_segments")))


# --- segmentation ------------------------------------------------------------------


def sentence_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return docs.select(
        "doc_id", F.posexplode(sentence_split("text")).alias("sent_no", "sentence")
    )


def word_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return docs.select("doc_id", word_count("text").alias("n_words"))


def segment_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = op.with_segments(_documents(spark, sf_dir))
    return docs.select("doc_id", F.array_join("segments", "\n--\n").alias("segments"))


def segments_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.explode_segments(op.with_segments(_documents(spark, sf_dir)), "doc_id")


def segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.segment_counts(op.with_segments(_documents(spark, sf_dir)), "doc_id")


# --- embedding ---------------------------------------------------------------------


def _encode_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks that hash segments: so many for each split of the scan, and no fewer than any shuffle has."""
    splits = table(spark, sf_dir, "documents").rdd.getNumPartitions()
    return max(TASKS_PER_SPLIT * splits, int(spark.conf.get("spark.sql.shuffle.partitions")))


def hash_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = segments_exploded(spark, sf_dir)
    vectors = op.hash_encode(segments, "doc_id", "seg_no", partitions=_encode_tasks(spark, sf_dir))
    return vectors.select("doc_id", "seg_no", "bucket", _rounded("weight").alias("weight"))


def encode_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = op.encode_segments(segments_exploded(spark, sf_dir))
    cells = _cells(vectors, "embedding", "doc_id", "seg_no")
    return cells.withColumnsRenamed({"pos": "bucket", "value": "weight"})


def mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    pooled = op.mean_pool(table(spark, sf_dir, "embeddings"), "label")
    return _cells(pooled, "mean", "label")


def doc_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    pooled = op.document_embeddings(table(spark, sf_dir, "embeddings"), "label")
    return _cells(pooled, "embedding", "label")


def embed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return _cells(op.embed_documents(docs), "embedding", "doc_id")


def dim_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = op.dim_check(table(spark, sf_dir, "embeddings"), dim=64)
    return checked.select("vec_id", "dim_ok")


# --- index and retrieval -----------------------------------------------------------


def index_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return (
        op.index_batches(docs, "doc_id", BATCH, ROWS_PER_BUCKET)
        .groupBy("batch")
        .agg(
            F.count("*").alias("n_docs"),
            F.min("doc_id").alias("first_doc"),
            F.max("doc_id").alias("last_doc"),
        )
    )


def label_centres(embeddings: DataFrame) -> DataFrame:
    """One query per label: the unit mean of its vectors."""
    centres = op.document_embeddings(embeddings, "label")
    return centres.withColumnsRenamed({"label": "query_id", "embedding": "query_vector"})


def knn_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = op.knn_exact(vectors, label_centres(vectors), K)
    return found.withColumn("score", _rounded("score"))


def knn_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    (first,) = vectors.agg(F.min_by("embedding", "vec_id")).first()
    return op.knn_single(vectors, first, K).withColumn("score", _rounded("score"))


def knn_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    centres = label_centres(vectors).withColumn("label", F.col("query_id"))
    found = op.knn_exact(vectors, centres, K, match_on="label")
    return found.withColumn("score", _rounded("score"))


def knn_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = op.lsh_model(vectors)
    indexed = op.lsh_index(vectors.select("vec_id", "embedding"), model)
    found = op.knn_lsh(indexed, label_centres(vectors), model, K)
    return found.withColumn("score", _rounded("score"))


def _cell_search(spark: SparkSession, sf_dir: str, filter_on: str | None) -> DataFrame:
    """The whole table indexed in cells; centres of labels asked for, each within its label if filtered."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    model = op.train_cells(vectors, "vec_id")
    path = scratch_dir(spark)
    op.append_cells(vectors, path, model, 0, "vec_id", filter_on=filter_on)
    search = op.CellSearch(spark, path, model, vectors.schema, filter_on=filter_on)
    centres = label_centres(vectors).withColumn("label", F.col("query_id"))
    found = search.found(centres, K, match_on=filter_on, probes=CELL_PROBES)
    return found.withColumn("score", _rounded("score"))


def knn_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cell_search(spark, sf_dir, None)


def knn_cells_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cell_search(spark, sf_dir, "label")


def search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts nearest to a few query strings, by the vectors the index would hold."""
    docs = op.embed_documents(_documents(spark, sf_dir).select("doc_id", "text"))
    vectors = op.HashingEncoder()(list(FULL_TEXT.values())).tolist()
    asked = spark.createDataFrame(
        list(zip(FULL_TEXT, vectors)), "query_id string, query_vector array<double>"
    )
    found = op.knn_exact(docs, asked, K, key="doc_id")
    return found.withColumn("score", _rounded("score"))


def url_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    # The keywords looked up are the urls of the pages in the target language.
    wanted = op.extract_pages(pages).select("url")
    # Headings are taken out first, so that no page text takes part in the join.
    headings = compute_once(pages, h1=first_h1("html")).select("page_id", "url", "h1")
    return op.keyword_lookup(headings, wanted)


def h1_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    headings = op.with_headings(_pages(spark, sf_dir))
    found = op.postings(headings, "page_id")
    return found.select("term", "page_id", "tf", F.col("doc_len").cast("bigint").alias("doc_len"))


def h1_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    headings = op.with_headings(_pages(spark, sf_dir))
    found = op.bm25_search(headings, FULL_TEXT, "page_id", k=K)
    return found.withColumn("score", _rounded("score"))


def _stored_search(df: DataFrame, key: str, text: str) -> DataFrame:
    """Postings of the whole table, appended in ``LOADS`` loads of stored rows, then searched."""
    spark = df.sparkSession
    path, schema = scratch_dir(spark), df.schema
    parts = f"{path}/rows"
    df.withColumn("load", F.pmod(F.xxhash64(key), F.lit(LOADS))).write.partitionBy("load").parquet(parts)
    for i in range(LOADS):
        append_postings(spark.read.schema(schema).parquet(f"{parts}/load={i}"), path, i, key, text)
    found = op.search_postings(spark, path, FULL_TEXT, K, schema[key].dataType)
    return found.select("query_id", F.col("key").alias(key), _rounded("score").alias("score"), "rank")


def h1_bm25_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    headings = op.with_headings(_pages(spark, sf_dir)).select("page_id", "h1")
    return _stored_search(headings, "page_id", "h1")


def text_bm25_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return _stored_search(docs, "doc_id", "text")


# --- metrics -----------------------------------------------------------------------


def _k_of_props() -> Column:
    return F.from_json("props", "k bigint")["k"]


def parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", _k_of_props().alias("k"))


def _event_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as extraction metrics: the value is processing, ``k`` loading time."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        F.col("value").alias("processing_time"),
        _k_of_props().cast("double").alias("load_time"),
        F.lit(0.25).alias("rabbit_connection_time"),
        (F.col("user_id") * 0.5).alias("download_time"),
    )


def metric_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = op.metric_total(_event_metrics(spark, sf_dir))
    return totals.select("event_id", _rounded("total_time").alias("total_time"))


def metric_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON metric messages, decoded and routed to their collections."""
    step = F.lit(None).cast("string")
    for kind, name in EVENT_STEPS.items():
        step = F.when(F.col("event_type") == kind, F.lit(name)).otherwise(step)
    message = F.struct(
        step.alias("step"),
        F.concat(F.lit("user-"), "user_id").alias("machine"),
        F.col("event_id").alias("batchsize"),
    )
    broken = F.substring(F.to_json(message), 1, 9)
    # Every user with an even number sends cut-off messages.
    value = F.when(F.col("user_id") % 2 == 0, broken).otherwise(F.to_json(message))
    events = spread(
        table(spark, sf_dir, "events").select("event_id", "event_type", "user_id"), "event_id"
    )
    routed = op.route_metrics(events.select(value.alias("value")))
    return routed.groupBy("collection", F.col("_error").alias("error")).agg(
        F.count("*").alias("n"),
        F.count_distinct("computer").alias("n_computers"),
        F.coalesce(F.sum("batchsize"), F.lit(0)).alias("sum_batchsize"),
    )


def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    totals = op.running_total(events, "user_id", "ts", "event_id", "value")
    return totals.select("event_id", "user_id", _rounded("running_total").alias("running_total"))


def metrics_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = op.metric_rollup(
        table(spark, sf_dir, "events"), "event_type", ts="ts", value="value", every="1 hour"
    )
    # Nine places: means of two-decimal values often lie half-way at the sixth.
    return rolled.withColumn("mean", F.round("mean", 9))


def metrics_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of days, from sketches of minutes merged to hours and those to days."""
    minutes = op.sketch_rollup(table(spark, sf_dir, "events"), "event_type", ts="ts", value="value")
    hours = op.merge_rollup(minutes, "event_type", every="1 hour")
    return op.with_quantiles(op.merge_rollup(hours, "event_type", every="1 day"))


QUERIES: dict[str, Query] = {
    "pages_scan": pages_scan,
    "resolve_paths": resolve_paths,
    "extract_text": extract_text_query,
    "extract_blocks": extract_blocks,
    "first_h1": first_h1_query,
    "site_blocks": site_blocks,
    "french_pages": french_pages,
    "encode_messages": encode_messages,
    "detect_lang": detect_lang,
    "detect_lang_ngram": detect_lang_ngram,
    "detect_lang_model": detect_lang_model,
    "french_documents": french_documents,
    "corpus_profile": corpus_profile,
    "sentence_split": sentence_split_query,
    "word_count": word_count_query,
    "segment_text": segment_text,
    "segments_exploded": segments_exploded,
    "segment_counts": segment_counts,
    "hash_encode": hash_encode,
    "encode_udf": encode_udf,
    "mean_pool": mean_pool,
    "doc_embedding": doc_embedding,
    "embed_documents": embed_documents,
    "dim_check": dim_check,
    "index_batches": index_batches,
    "knn_exact": knn_exact,
    "knn_single": knn_single,
    "knn_filtered": knn_filtered,
    "knn_lsh": knn_lsh,
    "knn_cells": knn_cells,
    "knn_cells_filtered": knn_cells_filtered,
    "search_documents": search_documents,
    "url_lookup": url_lookup,
    "h1_postings": h1_postings,
    "h1_bm25": h1_bm25,
    "h1_bm25_stored": h1_bm25_stored,
    "text_bm25_stored": text_bm25_stored,
    "parse_props": parse_props,
    "metric_total": metric_total,
    "metric_routing": metric_routing,
    "running_total": running_total,
    "metrics_rollup": metrics_rollup,
    "metrics_quantiles": metrics_quantiles,
}
