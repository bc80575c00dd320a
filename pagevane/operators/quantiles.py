"""Quantiles of metrics that can be merged: a sketch for each minute, hours and days made of them.

A median of medians is no median, so what is stored for a bucket is a KLL sketch, of which coarser buckets
are merged without reading the values again. Sketches are made and merged map-side, so what moves is one
sketch for each bucket and key of a task, whatever the number of rows. A sketch of at most ``K`` values holds
them all, and its quantiles are exact; beyond that the rank of an estimate is off by about ``2.3 / K`` of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 4096
QUANTILES = (0.5, 0.9, 0.99)


def sketch_rollup(
    df: DataFrame,
    *keys: str,
    ts: str = "created_at",
    value: str = "total_time",
    every: str = "1 minute",
    k: int = K,
) -> DataFrame:
    """``bucket_start, keys, n, sketch`` for each time bucket and key; works on a stream as it does on a table.

    ``n`` counts the rows with a value. Null values and NaN aren't in the sketch; rows without a time are in no
    bucket. A bucket without any value has a null sketch.
    """
    usable = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    return (
        df.withColumn("_value", usable)
        .groupBy(F.window(ts, every).alias("bucket"), *keys)
        .agg(F.count("_value").alias("n"), F.kll_sketch_agg_double("_value", k).alias("sketch"))
        .select(F.col("bucket.start").alias("bucket_start"), *keys, "n", _full("sketch").alias("sketch"))
    )


def merge_rollup(sketches: DataFrame, *keys: str, every: str = "1 hour", k: int = K) -> DataFrame:
    """Sketches of coarser buckets: those of ``sketch_rollup``, or of this function, merged.

    Without ``keys`` that ``sketches`` has, those are merged too.
    """
    return (
        sketches.groupBy(F.window("bucket_start", every).alias("bucket"), *keys)
        .agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))
        .select(F.col("bucket.start").alias("bucket_start"), *keys, "n", _full("sketch").alias("sketch"))
    )


def _full(sketch: str) -> Column:
    """The sketch, null where it holds nothing."""
    return F.when(F.col("n") > 0, F.col(sketch))


def quantile_name(q: float) -> str:
    return "p" + f"{q * 100:g}".replace(".", "_")


def with_quantiles(sketches: DataFrame, *quantiles: float, sketch: str = "sketch") -> DataFrame:
    """A column for each quantile (``p50``, ``p99_9``) in place of the sketch; null where it holds nothing."""
    quantiles = quantiles or QUANTILES
    named = [F.kll_sketch_get_quantile_double(sketch, F.lit(q)).alias(quantile_name(q)) for q in quantiles]
    return sketches.select(*(c for c in sketches.columns if c != sketch), *named)


def rank_of(sketch: str, value: Column) -> Column:
    """Share of a sketch's values that are at most ``value``."""
    return F.kll_sketch_get_rank_double(sketch, value.cast("double"))
