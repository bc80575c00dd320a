"""Pipeline metrics: routing, totals, time buckets, running sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagevane.operators.messages import ERROR, decode_messages

_DOUBLES = (
    "total_time download_time load_time processing_time rabbit_connection_time time_encode "
    "time_embeding time_get_rabbit_connection batch_time cumulative_index_time "
    "time_rabbitmq_connection time_es_connection"
).split()

# Union of the fields of all stage metrics; a stage leaves the others null.
METRIC_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("step", "warc_url", "url", "h1")]
    + [T.StructField(n, T.DoubleType()) for n in _DOUBLES]
    + [T.StructField("batchsize", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in ("computer", "machine")]
)

# Step name in a metric -> time-series collection that stores it.
COLLECTIONS = {
    "warc": "warc_logs",
    "vector": "vector_logs",
    "index": "index_logs",
    "index_batch_async": "index_logs",
}
TOTAL_PARTS = ("processing_time", "load_time", "rabbit_connection_time", "download_time")


def route_metrics(messages: DataFrame, value: str = "value") -> DataFrame:
    """Decode metric messages and name the ``collection`` of each.

    ``_error`` is set for bad JSON (``corrupt``) and for steps without a
    collection (``unknown step``); such rows have no collection. ``machine`` and
    ``computer`` are one field; ``step`` is dropped, the collection replaces it.
    """
    decoded = decode_messages(messages, METRIC_SCHEMA, required=(), value=value)
    collection = F.lit(None).cast("string")
    for step, name in COLLECTIONS.items():
        collection = F.when(F.col("step") == step, F.lit(name)).otherwise(collection)
    routed = decoded.withColumn("collection", collection)
    unknown = F.when(F.col("collection").isNull(), F.lit("unknown step"))
    return (
        routed.withColumn(ERROR, F.coalesce(F.col(ERROR), unknown))
        .withColumn("computer", F.coalesce("computer", "machine"))
        .drop("step", "machine")
    )


def stamp(df: DataFrame, name: str = "created_at") -> DataFrame:
    """Arrival time, one value per batch or micro-batch, and its date."""
    return df.withColumn(name, F.current_timestamp()).withColumn("date", F.to_date(name))


def metric_total(df: DataFrame, parts: tuple[str, ...] = TOTAL_PARTS) -> DataFrame:
    """Add ``total_time``, the sum of the parts of an extraction metric."""
    total: Column = F.col(parts[0])
    for part in parts[1:]:
        total = total + F.col(part)
    return df.withColumn("total_time", total)


def metric_rollup(
    df: DataFrame,
    *keys: str,
    ts: str = "created_at",
    value: str = "total_time",
    every: str = "1 minute",
) -> DataFrame:
    """Count, mean, maximum and median of ``value`` per time bucket and key."""
    return (
        df.groupBy(F.window(ts, every).alias("bucket"), *keys)
        .agg(
            F.count("*").alias("n"),
            F.avg(value).alias("mean"),
            F.max(value).alias("max"),
            F.percentile_approx(value, 0.5, 10_000).alias("median"),
        )
        .select(F.col("bucket.start").alias("bucket_start"), *keys, "n", "mean", "max", "median")
    )


def running_total(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    value: str,
    chunk: str = "hour",
    name: str = "running_total",
) -> DataFrame:
    """Running sum of ``value`` per key in the order of ``ts`` then ``tie``.

    A window over the key alone would put a hot key into one task. The sum is made
    in two levels instead: inside time chunks of a key, and over the chunk totals,
    which are few and are aggregated before they move. Every task then holds one
    chunk of a key at most. Rows with a null key are a key of their own; a null ``ts``
    comes before all others.
    """
    chunked = df.withColumn("_chunk", F.date_trunc(chunk, F.col(ts)))
    inside = Window.partitionBy(key, "_chunk").orderBy(ts, tie)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy("_chunk")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    totals = chunked.groupBy(key, "_chunk").agg(F.sum(value).alias("_sum"))
    offsets = totals.select(
        F.col(key).alias("_key"), F.col("_chunk").alias("_of"), F.coalesce(F.sum("_sum").over(before), F.lit(0.0)).alias("_offset")
    )
    return (
        chunked.withColumn("_inside", F.sum(value).over(inside))
        .join(offsets, F.col(key).eqNullSafe(F.col("_key")) & F.col("_chunk").eqNullSafe(F.col("_of")))
        .withColumn(name, F.col("_inside") + F.col("_offset"))
        .drop("_chunk", "_inside", "_offset", "_key", "_of")
    )
