from __future__ import annotations

import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagevane.operators import (
    decode_messages,
    metric_rollup,
    metric_total,
    require_fields,
    route_metrics,
    running_total,
    stamp,
)
from pagevane.operators.messages import TEXT_SCHEMA
from pagevane.plans.stages import metrics_step

from .conftest import table


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize(
    "message, collection, error",
    [
        ('{"step":"warc","warc_url":"w"}', "warc_logs", None),
        ('{"step":"vector","url":"u"}', "vector_logs", None),
        ('{"step":"index"}', "index_logs", None),
        ('{"step":"index_batch_async"}', "index_logs", None),
        ('{"step":"other"}', None, "unknown step"),
        ('{"url":"u"}', None, "unknown step"),
        ('{"step":', None, "corrupt"),
        ("", None, "corrupt"),
        (None, None, "corrupt"),
        ("[1]", None, "corrupt"),
    ],
)
def test_routing(spark, message, collection, error):
    row = route_metrics(messages(spark, message)).first()
    assert (row.collection, row._error) == (collection, error)


def test_fields_of_a_metric(spark):
    row = route_metrics(
        messages(spark, '{"step":"index","machine":"m","batchsize":7,"batch_time":0.5}')
    ).first()
    assert (row.computer, row.batchsize, row.batch_time) == ("m", 7, 0.5)
    assert "step" not in row and "machine" not in row


def test_required_fields(spark):
    values = ['{"url":"u","h1":"","text":"t"}', '{"url":"u","text":"t"}', "{", '{"url":null}']
    found = decode_messages(messages(spark, *values), TEXT_SCHEMA)
    assert [r._error for r in found.collect()] == [None, "missing h1", "corrupt", "missing url"]
    assert [r.value for r in found.collect()] == values
    assert require_fields(found.drop("_error")).filter("_error IS NULL").count() == 4


def test_store_and_reject(spark, tmp_path):
    out, rejected = str(tmp_path / "logs"), str(tmp_path / "rejected")
    batch = messages(spark, '{"step":"warc","total_time":1.5}', '{"step":"x"}', "{")
    for _ in range(2):
        metrics_step(batch, out, rejected, 0)
    stored = spark.read.parquet(out)
    assert stored.count() == 1
    row = stored.first()
    assert row.collection == "warc_logs" and row.total_time == 1.5
    assert isinstance(stored.schema["created_at"].dataType, T.TimestampType)
    reasons = spark.read.parquet(rejected).select("_error").collect()
    assert sorted(r[0] for r in reasons) == ["corrupt", "unknown step"]


def test_total(spark):
    names = ["processing_time", "load_time", "rabbit_connection_time", "download_time"]
    df = spark.createDataFrame([(1.0, 2.0, 4.0, 8.0)], names)
    assert metric_total(df).first().total_time == 15.0


def test_stamp_is_one_value(spark):
    assert stamp(spark.range(100)).select("created_at", "date").distinct().count() == 1


def test_rollup(spark):
    at = datetime.datetime(2024, 1, 1, 10, 0, 30)
    rows = [(at, "a", 1.0), (at + datetime.timedelta(seconds=29), "a", 3.0),
            (at + datetime.timedelta(seconds=30), "a", 9.0)]
    df = spark.createDataFrame(rows, "created_at timestamp_ntz, computer string, total_time double")
    found = metric_rollup(df, "computer").orderBy("bucket_start").collect()
    assert [(r.n, r.mean, r.max, r["median"]) for r in found] == [
        (2, 2.0, 3.0, 1.0),
        (1, 9.0, 9.0, 9.0),
    ]


@pytest.mark.parametrize("chunk", ["hour", "day", "minute"])
def test_running_total_equals_one_window(spark, chunk):
    events = table(spark, "events").select(
        "event_id",
        "ts",
        "value",
        # One key holds a third of all rows.
        F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("user_id")).alias("user_id"),
    )
    plain = Window.partitionBy("user_id").orderBy("ts", "event_id")
    plain = plain.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    expected = events.withColumn("r", F.sum("value").over(plain))
    expected = {r.event_id: r.r for r in expected.collect()}
    found = running_total(events, "user_id", "ts", "event_id", "value", chunk).collect()
    assert len(found) == len(expected)
    assert all(abs(r.running_total - expected[r.event_id]) < 1e-6 for r in found)


def test_running_total_keeps_rows_with_nulls(spark):
    rows = [("a", "2024-01-01 00:10:00", 1, 2.0), (None, "2024-01-01 00:20:00", 2, 3.0), ("a", None, 3, 4.0)]
    df = spark.createDataFrame(rows, "k string, t string, i int, v double").withColumn("t", F.to_timestamp("t"))
    found = {r.i: r.running_total for r in running_total(df, "k", "t", "i", "v").collect()}
    assert found == {1: 6.0, 2: 3.0, 3: 4.0}
