"""Streaming jobs: one per stage, and one that fuses all stages.

Every job runs a batch step per micro-batch into a folder named after the stream's own id and the batch. Spark
commits the source offsets only after the step has returned. What another stage reads is published once
(``sinks.tables.publish``): a replay finds it and leaves it alone, so nothing is lost and nothing is read twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagevane.operators.messages import ERROR
from pagevane.operators.metrics import metric_rollup
from pagevane.plans.stages import (
    Settings,
    archive_pages,
    build_index,
    embed_step,
    extract_step,
    index_step,
    metrics_step,
)
from pagevane.session import shared_dir


def _start(
    stream: DataFrame,
    name: str,
    step: Callable[[DataFrame, int], None],
    checkpoint: str | None,
    drain: bool,
    interval: str,
) -> StreamingQuery:
    location = _location(stream, name, checkpoint)
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", location)
    trigger = {"availableNow": True} if drain else {"processingTime": interval}
    return writer.queryName(name).trigger(**trigger).start()


def _location(stream: DataFrame, name: str, checkpoint: str | None) -> str:
    return checkpoint or f"{shared_dir(stream.sparkSession).rstrip('/')}/streams/{name}"


def _load_name(spark: SparkSession, location: str, batch_id: int) -> str:
    """Name of a batch's load: the stream's id, which its checkpoint keeps, and the batch.

    Another stream, or the same one begun anew, has another id and replaces nothing; a batch
    that is replayed has the same name.
    """
    (row,) = spark.read.json(f"{location}/metadata").select("id").collect()
    return f"{row['id']}-{batch_id}"


def extract_job(
    manifest: DataFrame,
    out: str,
    settings: Settings = Settings(),
    metrics: str | None = None,
    checkpoint: str | None = None,
    drain: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Manifest messages to text messages; ``drain`` stops when the queue is empty."""

    def step(batch: DataFrame, batch_id: int) -> None:
        load = _load_name(batch.sparkSession, _location(manifest, "extract", checkpoint), batch_id)
        pages = archive_pages(batch, timed=metrics is not None)
        extract_step(pages, out, load, settings, metrics, once=True)

    return _start(manifest, "extract", step, checkpoint, drain, interval)


def vectorize_job(
    texts: DataFrame,
    out: str,
    settings: Settings = Settings(),
    metrics: str | None = None,
    checkpoint: str | None = None,
    drain: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Text messages to document embeddings."""

    def step(batch: DataFrame, batch_id: int) -> None:
        load = _load_name(batch.sparkSession, _location(texts, "vectorize", checkpoint), batch_id)
        embed_step(batch, out, load, settings, metrics, once=True)

    return _start(texts, "vectorize", step, checkpoint, drain, interval)


def drop_replays(stream: DataFrame, *keys: str, within: str = "1 hour") -> DataFrame:
    """Keep the first of equal messages that arrive within ``within`` of each other.

    Repeats inside an Arrow batch go first, in the task that read them, so a message
    that was sent very often does not crowd one state partition.
    """
    keyed = stream.withColumn("_key", F.sha2(F.to_json(F.struct(*keys)), 256))

    def locally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("_key").to_numpy(zero_copy_only=False)
            _, first = np.unique(names, return_index=True)
            yield batch.take(pa.array(np.sort(first)))

    fewer = keyed.mapInArrow(locally, keyed.schema)
    arrived = fewer.withColumn("_arrived", F.current_timestamp())
    once = arrived.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_key"])
    return once.drop("_key", "_arrived")


def index_job(
    vectors: DataFrame,
    index: str,
    settings: Settings = Settings(),
    metrics: str | None = None,
    checkpoint: str | None = None,
    drain: bool = False,
    interval: str = "10 seconds",
    drop_repeated: bool = True,
) -> StreamingQuery:
    """Embeddings to the index, repeated messages dropped unless told otherwise."""
    once = drop_replays(vectors, "url", "h1", "embedding") if drop_repeated else vectors

    def step(batch: DataFrame, batch_id: int) -> None:
        load = _load_name(batch.sparkSession, _location(once, "index", checkpoint), batch_id)
        index_step(batch, index, load, settings, metrics)

    return _start(once, "index", step, checkpoint, drain, interval)


def fused_job(
    pages: DataFrame,
    index: str,
    work: str,
    settings: Settings = Settings(),
    metrics: str | None = None,
    checkpoint: str | None = None,
    drain: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Pages straight to the index: all stages inside one micro-batch."""

    def step(batch: DataFrame, batch_id: int) -> None:
        load = _load_name(batch.sparkSession, _location(pages, "fused", checkpoint), batch_id)
        build_index(batch.sparkSession, batch, index, work, load, settings, metrics)

    return _start(pages, "fused", step, checkpoint, drain, interval)


def metrics_job(
    messages: DataFrame,
    out: str,
    rejected: str,
    checkpoint: str | None = None,
    drain: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Metric messages to the time-series tables."""

    def step(batch: DataFrame, batch_id: int) -> None:
        load = _load_name(batch.sparkSession, _location(messages, "metrics", checkpoint), batch_id)
        metrics_step(batch, out, rejected, load)

    return _start(messages, "metrics", step, checkpoint, drain, interval)


def rollup_job(
    metrics: DataFrame,
    out: str,
    *keys: str,
    ts: str = "created_at",
    value: str = "total_time",
    every: str = "1 minute",
    late: str = "1 minute",
    checkpoint: str | None = None,
    drain: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Closed time buckets of metrics; rows later than the watermark are left out."""
    rolled = metric_rollup(
        metrics.withWatermark(ts, late), *keys, ts=ts, value=value, every=every
    )
    location = checkpoint or f"{shared_dir(metrics.sparkSession).rstrip('/')}/streams/rollup"
    writer = rolled.writeStream.format("parquet").outputMode("append")
    trigger = {"availableNow": True} if drain else {"processingTime": interval}
    options = {"path": out, "checkpointLocation": location}
    return writer.options(**options).queryName("rollup").trigger(**trigger).start()
