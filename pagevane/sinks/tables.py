"""Plain table and message sinks.

Every writer takes the folder of one batch. In a batch job it overwrites the folder. What a stream's next stage
reads is published instead: written aside, then given its name by one rename, once. A replayed batch finds its
folder and writes nothing, so the files that the next stage has seen stay the only ones, and half a batch is
never seen. Like Spark's own checkpoints this needs a file system that renames atomically.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagevane.operators.messages import ERROR, encode_messages
from pagevane.operators.metrics import METRIC_SCHEMA

OK, BAD, TIMES = "ok", "bad", "times"


def batch_path(path: str, batch: str | int) -> str:
    return f"{path.rstrip('/')}/batch={batch}"


def publish(spark: SparkSession, folder: str, write: Callable[[str], None]) -> bool:
    """Lets ``write`` fill a hidden folder, which then becomes ``folder``; does nothing if that is there.

    Returns whether it was written. A try that was lost leaves its hidden folder, which no reader lists.
    """
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(target):
        return False
    parent, name = folder.rstrip("/").rsplit("/", 1)
    aside = f"{parent}/_tries/{name}-{uuid.uuid4().hex}"
    write(aside)
    # Fails if the target has come into being since.
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context.rename(jvm.org.apache.hadoop.fs.Path(aside), target, options)
    return True


def write_checked(df: DataFrame, path: str, batch: str | int, once: bool = False) -> None:
    """Write good and bad rows of a batch in one job, apart by ``status``; ``once`` publishes them.

    Bad rows are those with ``_error`` set, and rows with a value in ``times`` are measurements, apart
    from both. One write, so the work that made the
    rows is done once and not once per outcome.
    """
    status = F.when(F.col(ERROR).isNull(), OK).otherwise(BAD)
    if "times" in df.columns:
        status = F.when(F.col("times").isNotNull(), TIMES).otherwise(status)
    rows = df.withColumn("status", status)

    def write(folder: str) -> None:
        rows.write.mode("overwrite").partitionBy("status").parquet(folder)

    if once:
        publish(df.sparkSession, batch_path(path, batch), write)
    else:
        write(batch_path(path, batch))


def checked_path(path: str, batch: str | int = "*", status: str = OK) -> str:
    """Path (with a glob over batches by default) of the rows with one status."""
    return f"{batch_path(path, batch)}/status={status}"


def write_messages(df: DataFrame, path: str, *fields: str) -> None:
    """JSON lines for the next stage to read."""
    encode_messages(df, *fields).write.mode("overwrite").text(path)


def write_trace(df: DataFrame, path: str) -> None:
    """Readable dump of the extracted pages, overwritten by each run."""
    df.write.mode("overwrite").json(path)


def write_metrics(df: DataFrame, path: str, batch: str | int) -> None:
    """Stored metrics by collection and date, the two columns time queries filter on."""
    rows = df.write.mode("overwrite").partitionBy("collection", "date")
    rows.parquet(batch_path(path, batch))


def emit_metric(spark: SparkSession, path: str | None, batch: str | int, **fields) -> None:
    """Publish one stage metric as a JSON message, once for a batch; no path, no metric."""
    if path is None:
        return
    row = {name: fields.get(name) for name in METRIC_SCHEMA.fieldNames()}
    unknown = set(fields) - set(row)
    if unknown:
        raise ValueError(f"unknown metric fields {sorted(unknown)}")
    one = spark.createDataFrame([tuple(row.values())], METRIC_SCHEMA)
    emit_metrics(one, path, batch, fields["step"])


def emit_metrics(rows: DataFrame, path: str, batch: str | int, step: str) -> None:
    """Publish the metrics of a stage's batch, a JSON message for each row, once."""
    folder = f"{path.rstrip('/')}/{step}-{batch}"
    publish(rows.sparkSession, folder, lambda aside: write_messages(rows, aside))
