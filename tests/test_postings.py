"""Stored postings against the search that scans, over loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagevane.operators import StoredSearch, bm25_search, search_postings
from pagevane.plans.catalog import FULL_TEXT
from pagevane.sinks import append_index, create_index, read_index
from pagevane.sinks.postings import BLOCK, append_postings, postings_path, read_blocks, term_counts

from .conftest import plan_of, table

SOME = {**FULL_TEXT, "none": "zzzz", "empty": "", "rare": "the qui 2024 nicht"}


def loaded(docs, path, loads=3):
    for i in range(loads):
        part = docs.filter(F.pmod("doc_id", F.lit(loads)) == i)
        append_postings(part, path, i, "doc_id", "text", buckets=8 * (i + 1))


def ranked(found, key):
    return sorted((r["query_id"], r["rank"], r[key], r["score"]) for r in found.collect())


def test_three_loads_equal_a_scan_of_all(spark, tmp_path):
    docs = table(spark, "documents", "sf0.01").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "the of the")], docs.schema))
    loaded(docs, str(tmp_path))
    key = docs.schema["doc_id"].dataType
    found = search_postings(spark, str(tmp_path), SOME, 10, key)
    assert ranked(found, "key") == ranked(bm25_search(docs, SOME, "doc_id", "text", 10), "doc_id")


def test_a_replayed_load_replaces_itself(spark, tmp_path):
    docs = table(spark, "documents").select("doc_id", "text")
    loaded(docs, str(tmp_path))
    append_postings(docs.filter(F.col("doc_id") % 3 == 1), str(tmp_path), 1, "doc_id", "text")
    found = search_postings(spark, str(tmp_path), SOME, 5, docs.schema["doc_id"].dataType)
    assert ranked(found, "key") == ranked(bm25_search(docs, SOME, "doc_id", "text", 5), "doc_id")


def test_a_search_opens_the_folders_of_its_terms_only(spark, tmp_path):
    docs = table(spark, "documents").select("doc_id", "text")
    loaded(docs, str(tmp_path), 1)
    plan = plan_of(search_postings(spark, str(tmp_path), {"q": "the of"}, 5, docs.schema["doc_id"].dataType))
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket" in partition_filters
    assert "In(term" in plan or "term IN" in plan


def test_blocks_are_in_order_of_impact_and_bounded(spark, tmp_path):
    docs = table(spark, "documents", "sf0.01").select("doc_id", "text")
    loaded(docs, str(tmp_path), 1)
    blocks = read_blocks(spark, str(tmp_path), docs.schema["doc_id"].dataType)
    wrong = blocks.filter(
        (F.col("n") > BLOCK) | (F.col("n") != F.size("entries"))
        | F.exists("entries", lambda e: (e["tf"] > F.col("max_tf")) | (e["length"] < F.col("min_length")))
    )
    assert wrong.count() == 0
    assert blocks.selectExpr("sum(n)").first()[0] == docs.select(F.inline(term_counts_of("text"))).count()


def term_counts_of(text):
    from pagevane.functions.text import let, tokens

    return let(F.array_distinct(tokens(text)), lambda t: F.transform(t, lambda x: F.struct(x.alias("x"))))


def test_counts_of_terms(spark):
    df = spark.createDataFrame([(["a", "a", "b", "c", "c", "c"],), ([],), (["x"],), (None,)], "t array<string>")
    found = [tuple(r) for r in df.select(F.inline(term_counts("t"))).collect()]
    assert found == [("a", 2), ("b", 1), ("c", 3), ("x", 1)]


def test_common_terms_are_mostly_skipped(spark, tmp_path):
    """A rare term decides; of a term in all texts only blocks near the top are read."""
    n = 20_000
    text = F.when(F.col("id") % 1000 == 0, F.concat(F.lit("needle "), F.repeat(F.lit("hay "), 3)))
    text = text.otherwise(F.concat(F.lit("hay "), F.repeat(F.lit("straw "), (F.col("id") % 17).cast("int"))))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"))
    append_postings(docs, str(tmp_path), 0, "doc_id", "text")
    search = StoredSearch(spark, str(tmp_path), {"q": "needle hay"}, 10, docs.schema["doc_id"].dataType)
    least = search.least_shares()
    read = search.blocks.filter(f"term = 'hay' and share >= {least['q', 'hay']!r}").count()
    held = search.blocks.filter("term = 'hay'").count()
    assert held >= n / BLOCK and read <= 3
    assert ranked(search.found(), "key") == ranked(bm25_search(docs, {"q": "needle hay"}, "doc_id", "text", 10), "doc_id")


def test_the_index_appends_its_postings(spark, tmp_path):
    index = str(tmp_path / "index")
    create_index(spark, index, 2)
    pages = table(spark, "pages").select("url", F.col("url").alias("h1")).withColumn("embedding", F.array(F.lit(1.0), F.lit(0.0)))
    append_index(pages, index, "a")
    append_index(pages.limit(20), index, "b")
    asked = {"q": "http www html", "r": "example com"}
    found = search_postings(spark, postings_path(index), asked, 15)
    rows = read_index(spark, index).select("url", "h1")
    want = bm25_search(rows, asked, "url", "h1", 15)
    assert ranked(found, "key") == ranked(want, "url")
    assert found.count()


def test_no_texts(spark, tmp_path):
    docs = table(spark, "documents").select("doc_id", "text")
    append_postings(docs.limit(0), str(tmp_path), 0, "doc_id", "text")
    assert search_postings(spark, str(tmp_path), SOME, 5, docs.schema["doc_id"].dataType).count() == 0
