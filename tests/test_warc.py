from __future__ import annotations

import datetime
import gzip
import time
import zlib

import pytest
from pyspark.sql import functions as F

from pagevane.plans.stages import archive_pages, build_index, extract_step, retrying_extract_step
from pagevane.operators import encode_messages, page_key
from pagevane.sinks import batch_path, checked_path, write_messages
from pagevane.sinks.attempts import archive_states, due, read_attempts, record_attempts
from pagevane.sources import read_archives, read_manifest, read_messages, read_pages, spread

from .conftest import table

FRENCH = "le la les des du et est une dans que qui pour elle sur au un de en"


def record(kind, url, body, http="Content-Type: text/html\r\n", content="application/http; msgtype=response"):
    if http is not None:
        body = b"HTTP/1.1 200 OK\r\n" + http.encode() + b"\r\n" + body
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\n"
    if url is not None:
        head += f"WARC-Target-URI: {url}\r\n"
    head += f"Content-Type: {content}\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


RECORDS = [
    record("warcinfo", None, b"software: x", None, "application/warc-fields"),
    record("request", "http://a/1", b"", None),
    record("response", "http://a/1", f"<h1>Un</h1><p>{FRENCH}</p>".encode()),
    record("response", "http://a/2", b"caf\xc3\xa9 \xff\xfe ok"),
    record("response", None, b"no url"),
    record(
        "response",
        "http://a/3",
        b"5\r\nabcde\r\n3;x=y\r\nfgh\r\n0\r\n\r\n",
        "Transfer-Encoding: chunked\r\n",
    ),
    record("response", "http://a/4", gzip.compress(b"zipped"), "Content-Encoding: gzip\r\n"),
    record("response", "http://a/5", zlib.compress(b"deflated"), "content-encoding: deflate\r\n"),
    record("response", "http://a/1", f"<h1>Deux</h1><p>{FRENCH}</p>".encode()),
]
BODIES = {
    "http://a/2": "café  ok",
    None: "no url",
    "http://a/3": "abcdefgh",
    "http://a/4": "zipped",
    "http://a/5": "deflated",
}


@pytest.fixture
def archives(tmp_path):
    folder = tmp_path / "crawl"
    folder.mkdir()
    # One gzip member per record, as crawls are written.
    (folder / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in RECORDS))
    (folder / "b.warc").write_bytes(b"".join(RECORDS))
    return folder


def read(spark, path, **options):
    return spark.read.format("warc").options(**options).load(str(path))


@pytest.mark.parametrize("name", ["a.warc.gz", "b.warc"])
def test_records(spark, archives, name):
    rows = read(spark, archives / name).collect()
    assert [r.rec_type for r in rows].count("response") == 7
    assert len(rows) == len(RECORDS)
    found = {r.url: r.html for r in rows if r.rec_type == "response" and r.url != "http://a/1"}
    assert found == BODIES
    assert len({r.offset for r in rows}) == len(rows)


def test_one_split_per_archive_and_type_filter(spark, archives):
    df = read(spark, archives)
    assert df.rdd.getNumPartitions() == 2
    responses = df.filter("rec_type = 'response'")
    assert responses.count() == 14
    assert df.filter("rec_type = 'request'").count() == 2
    assert df.filter("rec_type = 'response' AND rec_type = 'request'").count() == 0
    assert read(spark, f"file://{archives}").count() == 18
    assert read(spark, f"{archives}/*.gz").count() == 9


def test_repeated_urls_have_their_own_keys(spark, archives):
    rows = read(spark, archives).filter("url = 'http://a/1' AND rec_type = 'response'")
    keys = [r.k for r in rows.select(page_key().alias("k")).collect()]
    assert len(keys) == len(set(keys)) == 4


def test_damaged_archive(spark, archives):
    whole = (archives / "a.warc.gz").read_bytes()
    (archives / "c.warc.gz").write_bytes(whole[: len(whole) // 2])
    (archives / "d.warc").write_bytes(b"not an archive")
    with pytest.raises(Exception):
        read(spark, archives / "c.warc.gz").collect()
    rows = read(spark, archives, mode="PERMISSIVE").collect()
    broken = [r for r in rows if r.error]
    assert sorted(r.path.rsplit("/", 1)[1] for r in broken) == ["c.warc.gz", "d.warc"]
    assert any(r.path.endswith("c.warc.gz") and not r.error for r in rows)
    with pytest.raises(Exception, match="unknown mode"):
        read(spark, archives, mode="MAYBE").collect()


def test_large_records_span_batches(spark, tmp_path):
    body = b"x" * (3 << 20)
    path = tmp_path / "big.warc.gz"
    path.write_bytes(b"".join(gzip.compress(record("response", f"u{i}", body)) for i in range(7)))
    rows = read(spark, path).selectExpr("url", "length(html) AS n").collect()
    assert {(r.url, r.n) for r in rows} == {(f"u{i}", 3 << 20) for i in range(7)}


def test_manifest_to_records(spark, archives):
    manifest = archives.parent / "paths"
    manifest.write_text("a.warc.gz \r\n\n  \nb.warc\n")
    paths = read_manifest(spark, str(manifest), prefix=f"{archives}/")
    assert {r.warc_url for r in paths.collect()} == {"a.warc.gz", "b.warc"}
    assert read_archives(paths, partitions=2).count() == 14
    assert read_archives(paths, rec_type=None).count() == 18
    default = read_manifest(spark, str(manifest)).first()
    assert default.path == "https://data.commoncrawl.org/" + default.warc_url
    assert len(default.local_key) == 32


def test_archives_to_index(spark, archives, tmp_path):
    (archives / "bad.warc.gz").write_bytes(b"\x1f\x8bnot gzip")
    names = [("a.warc.gz",), ("b.warc",), ("bad.warc.gz",)]
    paths = spark.createDataFrame([(f"{archives}/{n}",) for (n,) in names], "path string")
    index, work, metrics = (str(tmp_path / n) for n in ("index", "work", "metrics"))
    load = build_index(spark, archive_pages(paths), index, work, "load", metrics=metrics)
    # Two French responses per archive; they share their url and are kept apart.
    assert sorted(r.h1 for r in load.collect()) == ["Deux", "Deux", "Un", "Un"]
    damaged = spark.read.parquet(checked_path(f"{work}/texts", status="bad")).collect()
    assert [r.path.rsplit("/", 1)[1] for r in damaged] == ["bad.warc.gz"]
    steps = spark.read.json(f"{metrics}/*").collect()
    assert sorted(r.step for r in steps) == ["index_batch_async", "vector", "warc"]
    assert [r.batchsize for r in steps if r.step == "index_batch_async"] == [4]


def test_every_archive_has_a_metric_of_its_own(spark, archives, tmp_path):
    (archives / "bad.warc.gz").write_bytes(b"\x1f\x8bnot gzip")
    (archives / "empty.warc").write_bytes(b"")
    names = ["a.warc.gz", "b.warc", "bad.warc.gz", "empty.warc", "gone.warc"]
    paths = spark.createDataFrame([(f"{archives}/{n}",) for n in names], "path string")
    index, work, metrics = (str(tmp_path / n) for n in ("index", "work", "metrics"))
    pages = archive_pages(paths, timed=True)
    counts = {r.path.rsplit("/", 1)[1]: r.times.records for r in pages.filter("times IS NOT NULL").collect()}
    assert counts == dict(zip(names, (7, 7, 0, 0, 0)))
    for load in ("one", "two"):
        found = build_index(spark, pages, index, work, load, metrics=metrics)
        assert sorted(r.h1 for r in found.collect()) == ["Deux", "Deux", "Un", "Un"]
    damaged = spark.read.parquet(checked_path(f"{work}/texts", "one", "bad")).collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in damaged) == ["bad.warc.gz", "gone.warc"]

    warc = spark.read.json(f"{metrics}/warc-one").collect()
    assert sorted(r.warc_url.rsplit("/", 1)[1] for r in warc) == names
    for r in warc:
        parts = (r.download_time, r.load_time, r.processing_time)
        assert min(parts) >= 0 and sum(parts) > 0 and abs(r.total_time - sum(parts)) < 1e-9
    packed = {r.warc_url.rsplit("/", 1)[1]: r.load_time > 0 for r in warc}
    assert packed["a.warc.gz"] and not packed["b.warc"]
    (vector,) = spark.read.json(f"{metrics}/vector-one").collect()
    assert vector.time_encode > 0 and vector.time_embeding > 0
    loads = [spark.read.json(f"{metrics}/index_batch_async-{n}").first() for n in ("one", "two")]
    assert loads[0].cumulative_index_time == pytest.approx(loads[0].batch_time)
    total = sum(r.batch_time for r in loads)
    assert loads[1].cumulative_index_time == pytest.approx(total)


def test_times_go_to_what_took_them(archives, monkeypatch):
    from pagevane.sources import warc

    def slow(path, opened=warc._open):
        time.sleep(0.2)
        return opened(path)

    monkeypatch.setattr(warc, "_open", slow)
    batches = warc.archive_batches(f"{archives}/a.warc.gz", {"response"}, True, timed=True)
    first = next(batches)
    assert first.num_rows == 7 and first.column("times").null_count == 7
    time.sleep(0.3)
    (last,) = batches
    (times,) = last.column("times").to_pylist()
    assert 0.2 <= times["download_time"] < 0.3 and times["processing_time"] >= 0.3
    assert 0 < times["load_time"] < 0.1 and times["records"] == 7


def test_trace_dump(spark, archives, tmp_path):
    paths = spark.createDataFrame([(f"{archives}/a.warc.gz",)], "path string")
    trace, out = str(tmp_path / "trace"), str(tmp_path / "out")
    extract_step(archive_pages(paths), out, 3, trace=trace)
    assert {r.h1 for r in spark.read.json(trace).collect()} == {"Un", "Deux"}
    assert spark.read.parquet(batch_path(out, 3)).count() == 2


def test_page_tables(spark, tmp_path):
    pages = read_pages(spark, "/root/testdata/sf0.001/pages.parquet")
    assert pages.count() == 50
    with pytest.raises(ValueError, match="missing"):
        read_pages(spark, "/root/testdata/sf0.001/events.parquet")
    assert spread(pages, "page_id").rdd.getNumPartitions() == 8
    many = pages.repartition(20)
    assert spread(many, "page_id") is many


def test_messages_round_trip(spark, tmp_path):
    pages = table(spark, "pages").select("page_id", "url")
    out = str(tmp_path / "queue")
    write_messages(pages, out, "url")
    raw = read_messages(spark, out)
    assert raw.count() == 50
    assert raw.first().value.startswith('{"url":"')
    assert encode_messages(pages).first().value.startswith('{"page_id":')


def test_bodies_of_several_members_and_unknown_encodings(spark, tmp_path):
    members = gzip.compress(b"one ") + gzip.compress(b"two")
    records = [
        record("response", "http://m/1", members, "Content-Encoding: gzip\r\n"),
        record("response", "http://m/2", b"\x0b\x02\x80", "Content-Encoding: br\r\n"),
        record("response", "http://m/3", b"plain", "Content-Encoding: identity\r\n"),
    ]
    (tmp_path / "c.warc").write_bytes(b"".join(records))
    found = {r.url: (r.html, r.error) for r in read(spark, tmp_path, mode="PERMISSIVE").collect()}
    assert found == {
        "http://m/1": ("one two", None),
        "http://m/2": (None, "ValueError: content encoding br"),
        "http://m/3": ("plain", None),
    }


def test_what_fails_for_now_is_raised_and_what_is_gone_set_aside(monkeypatch):
    from pagevane.sources import warc

    def out_of_reach(path):
        raise TimeoutError("no answer")

    monkeypatch.setattr(warc, "_open", out_of_reach)
    with pytest.raises(TimeoutError):
        list(warc.archive_batches("http://a/x.warc", None, permissive=True))
    monkeypatch.undo()
    (batch,) = warc.archive_batches("/nowhere/x.warc", None, permissive=True)
    assert batch.column("error").to_pylist()[0].startswith("FileNotFoundError")


# --- archives out of reach, tried again ------------------------------------------------------------


def at(minutes):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minutes)


def test_an_archive_out_of_reach_twice_is_read_at_the_third_try(spark, archives, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    away = tmp_path / "away.warc.gz"
    away.symlink_to(away)  # a loop: opening it is an error that isn't "no such file"
    good = f"{archives}/a.warc.gz"
    schema = "path string"

    def run(batch, minutes, *paths):
        retrying_extract_step(spark.createDataFrame([(p,) for p in paths], schema), out, batch, ledger, at(minutes))
        texts = spark.read.schema("path string, status string").parquet(batch_path(out, batch))
        return sorted({r.path for r in texts.filter("status = 'ok'").collect()})

    def state():
        (row,) = archive_states(read_attempts(spark, ledger)).collect()
        return row.path, row.tries, row.state

    assert run(1, 0, good, str(away)) == [good]
    assert state() == (str(away), 1, "waiting")
    assert run(2, 0.5) == [] and state()[1] == 1  # not yet
    assert run(3, 1) == [] and state()[1] == 2
    away.unlink()
    away.write_bytes((archives / "a.warc.gz").read_bytes())
    assert run(4, 2) == []  # the second wait is two minutes
    assert run(5, 3) == [str(away)] and state() == (str(away), 0, "done")
    assert run(5, 3) == [str(away)] and state() == (str(away), 0, "done")  # a replay
    assert run(6, 999) == []


def test_an_archive_is_set_aside_after_so_many_tries(spark, tmp_path):
    out, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    away = tmp_path / "away.warc.gz"
    away.symlink_to(away)
    none = spark.createDataFrame([], "path string")
    first = spark.createDataFrame([(str(away),)], "path string")
    for batch in range(5):
        retrying_extract_step(first if not batch else none, out, batch, ledger, at(1000 * batch), most_tries=3)
    (row,) = archive_states(read_attempts(spark, ledger), 3).collect()
    assert (row.tries, row.state, row.next_try) == (3, "set aside", None)
    assert row.reason.startswith("out of reach")


def test_waits_double_and_start_anew_after_a_success(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    rows = [("a", at(0), "x"), ("a", at(1), "y"), ("b", at(0), "x"), ("b", at(1), None), ("b", at(5), "z"), ("c", at(0), None)]
    for i, row in enumerate(rows):
        record_attempts(spark.createDataFrame([row], "path string, tried_at timestamp, reason string"), ledger, i)
    states = archive_states(read_attempts(spark, ledger))
    found = {r.path: (r.tries, r.state, r.next_try, r.reason) for r in states.collect()}
    assert found == {
        "a": (2, "waiting", at(3), "y"),
        "b": (1, "waiting", at(6), "z"),
        "c": (0, "done", None, None),
    }
    assert {r.path for r in due(states, F.lit(at(3))).collect()} == {"a"}
    assert due(archive_states(read_attempts(spark, str(tmp_path / "no ledger"))), F.lit(at(3))).collect() == []
