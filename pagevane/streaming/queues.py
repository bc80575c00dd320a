"""The queues between the stages, as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pagevane.operators.messages import MANIFEST_SCHEMA, decode_messages
from pagevane.sinks.tables import checked_path
from pagevane.sources.manifest import with_paths
from pagevane.sources.messages import message_stream


def json_queue(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """JSON messages of one schema; unusable ones carry ``_error``."""
    return decode_messages(message_stream(spark, path, max_files), schema)


def manifest_queue(
    spark: SparkSession, path: str, prefix: str | None = None, max_files: int | None = None
) -> DataFrame:
    """Archive paths from ``{"warc_url": ...}`` messages."""
    return with_paths(json_queue(spark, path, MANIFEST_SCHEMA, max_files), prefix)


def page_queue(
    spark: SparkSession, path: str, schema: str, max_files: int | None = None
) -> DataFrame:
    """Pages that arrive as Parquet files."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stage_queue(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """The good rows another stage has written to ``path``."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(checked_path(path))
