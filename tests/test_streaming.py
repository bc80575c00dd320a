"""Streaming jobs against their batch counterparts, replays and quarantine."""

from __future__ import annotations

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from pagevane.functions import l2_norm
from pagevane.operators import embed_documents, extract_pages
from pagevane.operators.messages import INDEX_SCHEMA, TEXT_SCHEMA
from pagevane.plans.stages import Settings
from pagevane.sinks import checked_path, read_index, write_messages
from pagevane.sources import message_stream
from pagevane.streaming import (
    drop_replays,
    extract_job,
    fused_job,
    index_job,
    json_queue,
    manifest_queue,
    metrics_job,
    page_queue,
    rollup_job,
    stage_queue,
    vectorize_job,
)

from .conftest import table
from .test_warc import RECORDS

PAGE_SCHEMA = "page_id bigint, url string, html string"


@pytest.fixture
def at(tmp_path):
    return lambda *names: str(tmp_path.joinpath(*names))


def drain(query):
    query.awaitTermination(300)
    assert query.exception() is None


def put(folder, name, *messages):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.writelines(m + "\n" for m in messages)


def text_message(i, text="Un. Deux."):
    return json.dumps({"url": f"u{i}", "h1": f"t{i}", "text": text})


def test_stream_equals_batch(spark, at):
    pages = table(spark, "pages")
    pages.repartition(3).write.parquet(at("pages"))
    stream = page_queue(spark, at("pages"), PAGE_SCHEMA, max_files=1)
    query = fused_job(stream, at("index"), at("work"), checkpoint=at("cp"), drain=True)
    drain(query)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    indexed = read_index(spark, at("index"))
    expected = embed_documents(extract_pages(pages).select("url", "h1", "text"))
    rows = {(r.url, r.h1): [round(x, 5) for x in r.embedding] for r in expected.collect()}
    found = {(r.url, r.h1): [round(x, 5) for x in r.embedding] for r in indexed.collect()}
    assert found == rows and rows
    assert indexed.filter(F.abs(l2_norm("embedding") - 1) > 1e-5).count() == 0


def test_stage_chain_from_archives_to_index(spark, at, tmp_path):
    (tmp_path / "b.warc").write_bytes(b"".join(RECORDS))
    put(at("manifest"), "1.json", '{"warc_url":"b.warc"}', '{"warc_url":', '{"x":1}')
    metrics = at("metrics")
    drain(
        extract_job(
            manifest_queue(spark, at("manifest"), prefix=f"{tmp_path}/"), at("texts"),
            metrics=metrics, checkpoint=at("cp1"), drain=True,
        )
    )
    aside = spark.read.parquet(checked_path(at("texts"), status="bad")).collect()
    assert sorted(r._error for r in aside) == ["corrupt", "missing warc_url"]
    texts = stage_queue(spark, at("texts"), TEXT_SCHEMA)
    drain(vectorize_job(texts, at("vectors"), metrics=metrics, checkpoint=at("cp2"), drain=True))
    vectors = stage_queue(spark, at("vectors"), INDEX_SCHEMA)
    drain(index_job(vectors, at("index"), metrics=metrics, checkpoint=at("cp3"), drain=True))
    assert sorted(r.h1 for r in read_index(spark, at("index")).collect()) == ["Deux", "Un"]

    queue = message_stream(spark, f"{metrics}/*")
    drain(metrics_job(queue, at("logs"), at("rejected"), checkpoint=at("cp4"), drain=True))
    logs = spark.read.parquet(at("logs"))
    assert {r.collection for r in logs.collect()} == {"warc_logs", "vector_logs", "index_logs"}
    assert logs.filter("batchsize = 2").count() == 1
    archive = logs.filter("collection = 'warc_logs'").collect()
    assert [r.warc_url for r in archive] == [f"{tmp_path}/b.warc"] and archive[0].total_time > 0


def test_replay_leaves_no_duplicates(spark, at):
    """The last batch is run again when its commit is lost after the write."""
    put(at("queue"), "1.json", *[text_message(i) for i in range(5)])

    def run():
        stream = json_queue(spark, at("queue"), TEXT_SCHEMA)
        drain(vectorize_job(stream, at("vectors"), checkpoint=at("cp"), drain=True))

    run()
    written = spark.read.parquet(checked_path(at("vectors"))).count()
    commits = at("cp", "commits")
    os.rename(os.path.join(commits, "0"), os.path.join(at("cp"), "lost-0"))
    crc = os.path.join(commits, ".0.crc")
    if os.path.exists(crc):
        os.rename(crc, os.path.join(at("cp"), "lost-crc"))
    run()
    assert spark.read.parquet(checked_path(at("vectors"))).count() == written == 5
    put(at("queue"), "2.json", text_message(9))
    run()
    assert spark.read.parquet(checked_path(at("vectors"))).count() == 6


def lose_commit(checkpoint, batch):
    """As if the driver was lost between a batch's write and its commit."""
    for name in (str(batch), f".{batch}.crc"):
        file = os.path.join(checkpoint, "commits", name)
        if os.path.exists(file):
            os.rename(file, os.path.join(checkpoint, f"lost-{name.strip('.')}-{len(os.listdir(checkpoint))}"))


def test_a_replay_is_not_read_again_downstream(spark, at):
    """The stage behind has read a batch that the stage before runs again; nothing repeats, also without a filter."""
    put(at("queue"), "1.json", *[text_message(i) for i in range(4)], text_message(0))

    def vectorize():
        stream = json_queue(spark, at("queue"), TEXT_SCHEMA)
        drain(vectorize_job(stream, at("vectors"), metrics=at("metrics"), checkpoint=at("cp1"), drain=True))

    def index():
        vectors = stage_queue(spark, at("vectors"), INDEX_SCHEMA)
        drain(index_job(vectors, at("index"), checkpoint=at("cp2"), drain=True, drop_repeated=False))

    vectorize()
    index()
    first = sorted(r.url for r in read_index(spark, at("index")).collect())
    assert first == ["u0", "u0", "u1", "u2", "u3"]
    files = sorted(f for _, _, names in os.walk(at("vectors")) for f in names)
    lose_commit(at("cp1"), 0)
    vectorize()
    index()
    assert sorted(f for _, _, names in os.walk(at("vectors")) for f in names) == files
    assert sorted(r.url for r in read_index(spark, at("index")).collect()) == first
    # A metric of the batch is there once, too.
    assert message_count(spark, at("metrics")) == 1
    put(at("queue"), "2.json", text_message(7))
    vectorize()
    index()
    assert sorted(r.url for r in read_index(spark, at("index")).collect()) == [*first, "u7"]


def message_count(spark, path):
    return spark.read.text(f"{path}/*").count()


def test_a_new_stream_into_the_same_folder_replaces_nothing(spark, at):
    for run in ("a", "b"):
        put(at(run), "1.json", text_message(run))
        stream = json_queue(spark, at(run), TEXT_SCHEMA)
        drain(vectorize_job(stream, at("vectors"), checkpoint=at(f"cp-{run}"), drain=True))
    assert {r.url for r in spark.read.parquet(checked_path(at("vectors"))).collect()} == {"ua", "ub"}


def test_an_unfinished_batch_is_not_seen(spark, at):
    from pagevane.sinks.tables import publish

    def half(folder):
        spark.range(3).write.parquet(folder)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        publish(spark, at("out", "batch=0"), half)
    assert not os.path.exists(at("out", "batch=0"))
    assert publish(spark, at("out", "batch=0"), lambda folder: spark.range(3).write.parquet(folder))
    assert not publish(spark, at("out", "batch=0"), lambda folder: spark.range(9).write.parquet(folder))
    assert spark.read.parquet(at("out", "batch=*")).count() == 3


def test_index_once_over_batches_of_a_stream(spark, at):
    row = '{"url":"u","h1":"t","embedding":[1.0,0.0]}'
    other = '{"url":"u","h1":null,"embedding":[0.0,1.0]}'
    for i, rows in enumerate([[row, row], [row], [other.replace("null", '""')], [row]]):
        put(at("queue"), f"{i}.json", *rows)
    stream = spark.readStream.schema(INDEX_SCHEMA).option("maxFilesPerTrigger", 1).json(at("queue"))
    settings = Settings(dim=2, index_once=True)
    drain(index_job(stream, at("index"), settings, checkpoint=at("cp"), drain=True, drop_repeated=False))
    assert sorted(r.h1 for r in read_index(spark, at("index")).collect()) == ["", "t"]
    lose_commit(at("cp"), 3)
    stream = spark.readStream.schema(INDEX_SCHEMA).option("maxFilesPerTrigger", 1).json(at("queue"))
    drain(index_job(stream, at("index"), settings, checkpoint=at("cp"), drain=True, drop_repeated=False))
    assert read_index(spark, at("index")).count() == 2


def test_bad_messages_do_not_stop_the_stream(spark, at):
    good = [text_message(i) for i in range(3)]
    bad = ["{", '{"url":"u"}', text_message(8, "  "), ""]
    put(at("queue"), "1.json", *good, *bad)
    stream = json_queue(spark, at("queue"), TEXT_SCHEMA)
    drain(vectorize_job(stream, at("vectors"), checkpoint=at("cp"), drain=True))
    assert spark.read.parquet(checked_path(at("vectors"))).count() == 3
    aside = spark.read.parquet(checked_path(at("vectors"), status="bad"))
    assert sorted(r._error for r in aside.collect()) == [
        "corrupt", "corrupt", "missing h1", "no segments",
    ]
    assert {"{", '{"url":"u"}'} <= {r.value for r in aside.collect()}


@pytest.mark.parametrize("drop, expected", [(True, 2), (False, 6)])
def test_repeated_messages(spark, at, drop, expected):
    row = '{"url":"u","h1":"t","embedding":[1.0,0.0]}'
    other = '{"url":"u","h1":"t","embedding":[0.0,1.0]}'
    put(at("queue"), "1.json", row, row, other)
    put(at("queue"), "2.json", row, other, row)
    stream = spark.readStream.schema(INDEX_SCHEMA).option("maxFilesPerTrigger", 1).json(at("queue"))
    query = index_job(
        stream, at("index"), Settings(dim=2), checkpoint=at("cp"), drain=True, drop_repeated=drop
    )
    drain(query)
    assert read_index(spark, at("index")).count() == expected


def test_drop_replays_keeps_columns(spark, at):
    put(at("queue"), "1.json", text_message(1), text_message(1))
    stream = json_queue(spark, at("queue"), TEXT_SCHEMA)
    assert drop_replays(stream, "url").columns == stream.columns


def test_back_pressure(spark, at):
    for i in range(4):
        put(at("queue"), f"{i}.json", text_message(i))
    stream = json_queue(spark, at("queue"), TEXT_SCHEMA, max_files=1)
    query = vectorize_job(stream, at("vectors"), checkpoint=at("cp"), drain=True)
    drain(query)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1] * 4


def test_late_metrics_are_left_out(spark, at):
    start = datetime.datetime(2024, 1, 1, 10)
    schema = "created_at timestamp, computer string, total_time double"

    def write(name, *minutes):
        rows = [(start + datetime.timedelta(minutes=m), "a", float(m)) for m in minutes]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(at("metrics", name))

    def run():
        stream = spark.readStream.schema(schema).parquet(at("metrics", "*"))
        drain(rollup_job(stream, at("rollup"), "computer", checkpoint=at("cp"), drain=True))

    write("1", 0, 0.5, 1, 10)
    run()
    write("2", 0.7, 20)
    run()
    found = spark.read.parquet(at("rollup")).orderBy("bucket_start").collect()
    assert [(r.bucket_start.minute, r.n) for r in found] == [(0, 2), (1, 1), (10, 1)]


def test_checkpoints_default_to_the_shared_folder(spark, at, monkeypatch):
    monkeypatch.setattr("pagevane.streaming.jobs.shared_dir", lambda _: at("shared"))
    put(at("queue"), "1.json", text_message(1))
    drain(vectorize_job(json_queue(spark, at("queue"), TEXT_SCHEMA), at("v"), drain=True))
    assert os.path.isdir(at("shared", "streams", "vectorize", "commits"))


def test_messages_feed_a_stream(spark, at):
    write_messages(table(spark, "pages").select("url").limit(3), at("queue"), "url")
    stream = message_stream(spark, at("queue"))
    assert stream.isStreaming and stream.columns == ["value"]
