"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from pagevane import operators as op
from pagevane.plans import catalog
from pagevane.session import cut_lineage, shared_dir

from .conftest import DATA, plan_of, table

SF = f"{DATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_joins(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    "build",
    [
        lambda spark: op.extract_pages(table(spark, "pages")),
        lambda spark: op.language_filter(table(spark, "documents")),
        lambda spark: op.explode_segments(op.with_segments(table(spark, "documents")), "doc_id"),
        lambda spark: op.embed_documents(table(spark, "documents").select("doc_id", "text")),
        lambda spark: op.dim_check(table(spark, "embeddings"), 64).filter("dim_ok"),
    ],
)
def test_row_work_never_shuffles(spark, build):
    assert "Exchange" not in plan_of(build(spark))


def test_costly_columns_are_computed_once(spark):
    plan = plan_of(op.extract_pages(table(spark, "pages")))
    assert plan.count("|nav\\b") == 1
    assert plan.count("INSET") + plan.count(" IN (") >= 1
    assert plan.count("[^\\p{L}]+") == 1


@pytest.mark.parametrize(
    "name, columns",
    [
        ("first_h1", {"page_id", "html"}),
        ("resolve_paths", {"page_id", "url"}),
        ("word_count", {"doc_id", "text"}),
        ("parse_props", {"event_id", "props"}),
        ("running_total", {"event_id", "user_id", "ts", "value"}),
        ("dim_check", {"vec_id", "embedding"}),
    ],
)
def test_scans_read_only_their_columns(spark, name, columns):
    plan = plan_of(entry.queries()[name](spark, SF))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert columns == {part.split(":")[0] for part in schema.split(",") if ":" in part}


def test_running_total_has_no_window_over_a_whole_key(spark):
    plan = plan_of(entry.queries()["running_total"](spark, SF))
    windows = [line for line in plan.splitlines() if " Window [" in line or "- Window [" in line]
    assert any("_chunk" in w.split("windowspecdefinition(")[1].split("DESC")[0] for w in windows)
    assert "partial_sum" in plan


def test_lineage_is_cut_in_the_shared_folder(spark):
    df = cut_lineage(spark.range(10))
    assert df.count() == 10
    assert shared_dir(spark)
    assert "Range" not in plan_of(df)
