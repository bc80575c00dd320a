"""The pipeline stages as batch steps.

Each takes a bounded DataFrame and writes the folder of one batch. The streaming
jobs run the same functions once per micro-batch, so both modes give the same
tables, and running a step again with the same batch replaces its output.
"""

from __future__ import annotations

import datetime
import time
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagevane.functions.segment import MAX_WORDS, OVERLAP_SENTENCES
from pagevane.functions.vectors import DIM
from pagevane.operators.embed import Encoder, EncoderFactory, HashingEncoder, dim_check, embed_documents
from pagevane.operators.extract import TARGET_LANG, extract_pages
from pagevane.operators.messages import ERROR, require_fields
from pagevane.operators.metrics import route_metrics, stamp
from pagevane.sinks import (
    append_index,
    create_index,
    emit_metric,
    emit_metrics,
    index_dim,
    write_checked,
    write_metrics,
    write_trace,
)
from pagevane.sinks.attempts import MOST_TRIES, archive_states, due, read_attempts, record_attempts
from pagevane.sinks.tables import BAD, TIMES, batch_path
from pagevane.sources.warc import TIMES_SCHEMA, UNREACHABLE, read_archives

# Seconds of indexing since this driver started, by index.
_indexing: dict[str, float] = defaultdict(float)


@dataclass(frozen=True)
class Settings:
    """Parameters of the pipeline."""

    lang: str = TARGET_LANG
    max_words: int = MAX_WORDS
    overlap_sentences: int = OVERLAP_SENTENCES
    dim: int = DIM
    encoder: EncoderFactory = HashingEncoder
    # Tasks to spread a heavy encoder over; None keeps the splits of the input.
    encode_partitions: int | None = None
    computer: str = "spark"
    # Index a message once, however many loads bring it.
    index_once: bool = False


def archive_pages(
    paths: DataFrame, partitions: int | None = None, timed: bool = False, report: bool = False
) -> DataFrame:
    """Response records of the archives in ``paths``.

    Damaged archives, and manifest messages that could not be decoded, are rows
    with ``_error`` set. ``timed`` adds the measured times of each archive, and
    ``report`` makes archives out of reach such rows too (see ``read_archives``).
    """
    usable = paths.filter(F.col(ERROR).isNull()) if ERROR in paths.columns else paths
    records = read_archives(usable, mode="PERMISSIVE", partitions=partitions, timed=timed, report=report)
    pages = records.withColumnRenamed("error", ERROR)
    if ERROR not in paths.columns:
        return pages
    rejected = paths.filter(F.col(ERROR).isNotNull()).select(F.col("value").alias("path"), ERROR)
    return pages.unionByName(rejected, allowMissingColumns=True)


def extract_step(
    pages: DataFrame,
    out: str,
    batch: str | int,
    settings: Settings = Settings(),
    metrics: str | None = None,
    trace: str | None = None,
    once: bool = False,
) -> None:
    """Pages to text messages ``url, h1, text`` in ``out``; ``once`` publishes a stream's batch.

    Metrics are one message for each archive if its times were measured (``archive_pages(timed=True)``),
    otherwise one for the batch.
    """
    started = time.monotonic()
    timed = "times" in pages.columns
    damaged = F.col(ERROR).isNotNull() if ERROR in pages.columns else None
    measured = F.col("times").isNotNull() if timed else F.lit(False)
    texts = extract_pages(
        pages, settings.lang, keep=measured if damaged is None else damaged | measured
    )
    if damaged is None:
        texts = require_fields(texts)
    # Where something was rejected, its path (or message) is kept with the reason.
    place = [F.col(c) for c in ("path", "times") if c in pages.columns]
    rows = texts.select("url", "h1", "text", *place, ERROR)
    # Few pages pass the language filter; rebalancing turns the many near-empty
    # outputs of the scan into files of even size.
    write_checked(rows.hint("rebalance"), out, batch, once)
    if trace is not None:
        written = pages.sparkSession.read.parquet(batch_path(out, batch))
        write_trace(written.filter("status = 'ok'").select("url", "h1", "text"), trace)
    spent = time.monotonic() - started
    if not timed:
        emit_metric(
            pages.sparkSession, metrics, batch, step="warc", warc_url=str(batch),
            total_time=spent, processing_time=spent, computer=settings.computer,
        )
    elif metrics is not None:
        emit_metrics(_archive_metrics(pages.sparkSession, out, batch, settings), metrics, batch, "warc")


def retrying_extract_step(
    paths: DataFrame,
    out: str,
    batch: str | int,
    ledger: str,
    now: datetime.datetime,
    settings: Settings = Settings(),
    metrics: str | None = None,
    most_tries: int = MOST_TRIES,
    partitions: int | None = None,
) -> None:
    """``extract_step`` of the archives in ``paths`` and of those in ``ledger`` whose next try has come.

    An archive out of reach is a bad row and a try in the ledger: it is read again by a later batch, after
    a wait that doubles, and is set aside after ``most_tries``. ``now`` is the batch's time: with the
    same one, a batch that runs again reads the same archives. Archives set aside are read again if ``paths``
    names them.
    """
    spark = paths.sparkSession
    moment = F.lit(now).cast("timestamp")
    retried = due(archive_states(read_attempts(spark, ledger, without=batch), most_tries), moment)
    todo = paths.select("path").union(retried).distinct()
    extract_step(archive_pages(todo, partitions, timed=True, report=True), out, batch, settings, metrics)
    written = spark.read.schema(f"path string, {ERROR} string, status string").parquet(batch_path(out, batch))
    failed = written.filter((F.col("status") == BAD) & F.col(ERROR).startswith(UNREACHABLE))
    failed = failed.select("path", F.col(ERROR).alias("reason"))
    worked = retried.join(failed.select("path"), "path", "left_anti").withColumn("reason", F.lit(None).cast("string"))
    record_attempts(failed.union(worked).withColumn("tried_at", moment), ledger, batch)


def _archive_metrics(
    spark: SparkSession, out: str, batch: str | int, settings: Settings
) -> DataFrame:
    """The extraction metric of each archive of a batch that was written."""
    schema = f"path string, times {TIMES_SCHEMA}, status string"
    written = spark.read.schema(schema).parquet(batch_path(out, batch))
    parts = ("download_time", "load_time", "processing_time")
    total = sum((F.col(f"times.{p}") for p in parts[1:]), F.col(f"times.{parts[0]}"))
    return written.filter(F.col("status") == TIMES).select(
        F.lit("warc").alias("step"),
        F.col("path").alias("warc_url"),
        total.alias("total_time"),
        *[f"times.{p}" for p in parts],
        F.lit(settings.computer).alias("computer"),
    )


class _TimedEncoder:
    """A factory whose encoders add the seconds that they take to an accumulator."""

    def __init__(self, factory: EncoderFactory, seconds):
        self.factory = factory
        self.seconds = seconds

    def __call__(self) -> Encoder:
        encode, seconds = self.factory(), self.seconds

        def timed(texts):
            started = time.monotonic()
            vectors = encode(texts)
            seconds.add(time.monotonic() - started)
            return vectors

        return timed


def embed_step(
    texts: DataFrame,
    out: str,
    batch: str | int,
    settings: Settings = Settings(),
    metrics: str | None = None,
    once: bool = False,
) -> None:
    """Text messages to document embeddings ``url, h1, embedding`` in ``out``.

    Rows with ``_error`` (from decoding), without a required field, without any
    sentence or with a vector of the wrong length are written with status ``bad``.
    In the metric ``time_encode`` is the sum over all tasks of the seconds inside the encoder (tasks
    that ran twice count twice), ``time_embeding`` the seconds that the step took.
    """
    started = time.monotonic()
    seconds = texts.sparkSession.sparkContext.accumulator(0.0)
    encoder = _TimedEncoder(settings.encoder, seconds)
    before = texts.columns
    checked = texts if ERROR in before else require_fields(texts, "url", "h1", "text")
    # A rejected message must not cost an encoder call.
    usable = checked.withColumn("text", F.when(F.col(ERROR).isNull(), F.col("text")))
    if settings.encode_partitions:
        usable = usable.repartition(settings.encode_partitions)
    vectors = dim_check(
        embed_documents(
            usable, "text", encoder, settings.max_words, settings.overlap_sentences
        ),
        settings.dim,
    )
    reason = (
        F.when(F.col(ERROR).isNotNull(), F.col(ERROR))
        .when(F.col("embedding").isNull(), "no segments")
        .when(~F.col("dim_ok"), "wrong dimension")
    )
    keep = ["url", "h1", "embedding", *(["value"] if "value" in before else [])]
    write_checked(vectors.withColumn(ERROR, reason).select(*keep, ERROR), out, batch, once)
    spent = time.monotonic() - started
    emit_metric(
        texts.sparkSession, metrics, batch, step="vector", url=str(batch),
        time_encode=seconds.value, time_embeding=spent, computer=settings.computer,
    )


def index_step(
    vectors: DataFrame,
    index: str,
    batch: str | int,
    settings: Settings = Settings(),
    metrics: str | None = None,
) -> None:
    """Append embeddings to the index; the batch counts as done once it is written.

    ``batch`` names the load and must be unique to the run; the same name again is a replay and
    replaces its load. What can't be indexed is set aside (see ``append_index``).
    """
    spark = vectors.sparkSession
    started = time.monotonic()
    create_index(spark, index, settings.dim)
    if index_dim(spark, index) != settings.dim:
        raise ValueError(f"index has dimension {index_dim(spark, index)}, not {settings.dim}")
    written = append_index(vectors, index, batch, settings.index_once)
    spent = time.monotonic() - started
    _indexing[index] += spent
    emit_metric(
        spark, metrics, batch, step="index_batch_async", batchsize=written, batch_time=spent,
        cumulative_index_time=_indexing[index], machine=settings.computer,
    )


def metrics_step(messages: DataFrame, out: str, rejected: str, batch: str | int) -> None:
    """Metric messages to their time-series tables; what cannot be routed to ``rejected``."""
    routed = route_metrics(messages)
    write_metrics(stamp(routed.filter(F.col(ERROR).isNull()).drop(ERROR, "value")), out, batch)
    write_checked(routed.filter(F.col(ERROR).isNotNull()).select("value", ERROR), rejected, batch)


def build_index(
    spark: SparkSession,
    pages: DataFrame,
    index: str,
    work: str,
    batch: str | int,
    settings: Settings = Settings(),
    metrics: str | None = None,
) -> DataFrame:
    """Pages (or archive records) to the index in one call; returns the indexed load.

    ``batch`` is the name of this load, another one for each run. The stages meet in tables
    under ``work``, so that the loss of an executor never repeats an earlier stage; a run that
    failed is run again as a whole, under the same name.
    """
    texts, vectors = f"{work}/texts", f"{work}/vectors"
    extract_step(pages, texts, batch, settings, metrics)
    embed_step(_read_ok(spark, texts, batch, "url string, h1 string, text string"),
               vectors, batch, settings, metrics)
    index_step(
        _read_ok(spark, vectors, batch, "url string, h1 string, embedding array<float>"),
        index, batch, settings, metrics,
    )
    return spark.read.parquet(f"{index.rstrip('/')}/load={batch}")


def _read_ok(spark: SparkSession, path: str, batch: str | int, schema: str) -> DataFrame:
    # Reads the batch folder, which always exists, and prunes to the good rows.
    whole = spark.read.schema(f"{schema}, status string").parquet(batch_path(path, batch))
    return whole.filter("status = 'ok'").drop("status")


__all__ = [
    "Settings",
    "archive_pages",
    "build_index",
    "embed_step",
    "extract_step",
    "index_step",
    "metrics_step",
    "retrying_extract_step",
]
