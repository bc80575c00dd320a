"""Rows and fixed-size batches for the vector index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BATCH_SIZE = 1000
ROWS_PER_BUCKET = 100_000


def index_rows(df: DataFrame) -> DataFrame:
    """The three indexed fields; the text is not part of the index."""
    return df.select("url", "h1", F.col("embedding").cast("array<float>").alias("embedding"))


def index_batches(
    df: DataFrame,
    key: str,
    batch_size: int = BATCH_SIZE,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``batch``: every batch has exactly ``batch_size`` rows, the last the rest.

    Rows are numbered without a global sort: inside hash buckets of the unique
    ``key``, whose number follows the row count, plus the rows of the buckets
    before. Only the short table of bucket sizes is numbered as a whole.
    """
    total = df.agg(F.greatest(F.ceil(F.count("*") / rows_per_bucket), F.lit(1)).alias("n"))
    hashed = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    # Null keys are a bucket of their own, before all others.
    bucketed = df.withColumn("_bucket", F.coalesce(F.pmod(hashed, total.scalar()), F.lit(-1)))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    position = F.col("_offset") + F.col("_inside") - 1
    return (
        bucketed.withColumn("_inside", inside)
        .join(offsets, "_bucket")
        .withColumn("batch", F.floor(position / batch_size).cast("bigint"))
        .drop("_bucket", "_inside", "_offset")
    )
