"""Message queues as streams or tables of one JSON string per row.

A directory of JSON lines is the queue by default; any other replayable source
(such as Kafka, whose ``value`` is cast to string) gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def message_stream(
    spark: SparkSession,
    path: str | None = None,
    max_files: int | None = None,
    fmt: str = "text",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Stream of raw messages in ``value``; ``max_files`` limits one micro-batch.

    Messages are read as text, so broken JSON reaches the quarantine instead of
    stopping the stream. With ``fmt="kafka"`` pass the broker and topic, and the
    limit (``maxOffsetsPerTrigger``), in ``options``.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.load(path) if path else reader.load()
    return stream.select(F.col("value").cast("string").alias("value"))
