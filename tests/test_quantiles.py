from __future__ import annotations

import datetime
import math
import random

from pyspark.sql import functions as F

from pagevane.operators import merge_rollup, rank_of, sketch_rollup, with_quantiles

from .conftest import table

SCHEMA = "created_at timestamp, step string, total_time double"


def at(minutes):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minutes)


def exact(values, q):
    return sorted(values)[max(math.ceil(q * len(values)), 1) - 1]


def test_small_sketches_are_exact(spark):
    rng = random.Random(1)
    rows = [(at(rng.randrange(300)), rng.choice("ab"), rng.random()) for _ in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    minutes = sketch_rollup(df, "step")
    hours = merge_rollup(minutes, "step")
    for r in with_quantiles(hours, 0.25, 0.5, 0.999).collect():
        own = [v for t, s, v in rows if s == r.step and t.replace(minute=0) == r.bucket_start]
        assert r.n == len(own)
        assert (r.p25, r.p50, r.p99_9) == tuple(exact(own, q) for q in (0.25, 0.5, 0.999))


def test_merged_sketches_keep_the_error_bound(spark):
    events = table(spark, "events", "sf0.1")
    values = [r.value for r in events.select("value").collect()]
    k = 200
    hours = sketch_rollup(events, "event_type", ts="ts", value="value", every="1 hour", k=k)
    days = merge_rollup(hours, "event_type", every="1 day", k=k)
    whole = merge_rollup(days, every="1000 days", k=k).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))
    (row,) = with_quantiles(whole, *(i / 20 for i in range(1, 20))).collect()
    assert row.n == len(values)
    for i, found in enumerate(row[1:], 1):
        below, upto = (sum(compare(v) for v in values) / len(values) for compare in (found.__gt__, found.__ge__))
        assert below - 0.03 <= i / 20 <= upto + 0.03


def test_nulls_and_nan_are_left_out(spark):
    rows = [(at(0), "a", 1.0), (at(0), "a", None), (at(0), "a", float("nan")), (at(1), "b", None), (None, "a", 2.0), (at(0), None, 3.0)]
    minutes = sketch_rollup(spark.createDataFrame(rows, SCHEMA), "step")
    found = {(r.bucket_start, r.step): (r.n, r.p50) for r in with_quantiles(minutes, 0.5).collect()}
    assert found == {(at(0), "a"): (1, 1.0), (at(1), "b"): (0, None), (at(0), None): (1, 3.0)}
    hours = merge_rollup(minutes, "step")
    found = {(r.bucket_start, r.step): (r.n, r.p50) for r in with_quantiles(hours, 0.5).collect()}
    assert found == {(at(0), "a"): (1, 1.0), (at(0), "b"): (0, None), (at(0), None): (1, 3.0)}
    ranks = minutes.filter("step = 'a'").select(rank_of("sketch", F.lit(0.5)).alias("l"), rank_of("sketch", F.lit(1)).alias("h"))
    assert tuple(ranks.first()) == (0.0, 1.0)
    assert sketch_rollup(spark.createDataFrame([], SCHEMA), "step").collect() == []


def test_stored_minutes_are_merged_later(spark, tmp_path):
    events = table(spark, "events")
    path = str(tmp_path / "minutes")
    sketch_rollup(events, "event_type", ts="ts", value="value").write.parquet(path)
    stored = with_quantiles(merge_rollup(spark.read.parquet(path), "event_type", every="1 day"))
    direct = with_quantiles(sketch_rollup(events, "event_type", ts="ts", value="value", every="1 day"))
    assert sorted(stored.collect()) == sorted(direct.collect())
