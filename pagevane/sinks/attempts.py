"""A ledger of archives that were out of reach: what to try again, when, and what to set aside.

``<path>/batch=B`` holds the tries of one batch: every archive that failed, and those of earlier failures that
worked. The state of an archive is what its tries add up to, so nothing is ever updated; a batch that runs
again replaces its own tries and doesn't see them. Archives that worked at once never enter, so the ledger
follows the failures, not the archives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagevane.sinks.seen import _exists

SCHEMA = "path string, tried_at timestamp, reason string, batch string"
MOST_TRIES = 5
FIRST_WAIT = 60  # seconds; each further wait is twice as long
LONGEST_WAIT = 24 * 3600


def read_attempts(spark: SparkSession, ledger: str, without: str | int | None = None) -> DataFrame:
    """All tries, but for those of the batch ``without``; null ``reason`` where an archive worked."""
    if not _exists(spark, ledger):
        return spark.createDataFrame([], SCHEMA)
    tries = spark.read.schema(SCHEMA).parquet(ledger)
    return tries if without is None else tries.filter(F.col("batch") != str(without))


def _wait(tries: Column, first: int) -> Column:
    return F.least(F.lit(first) * F.pow(F.lit(2.0), tries - 1), F.lit(float(LONGEST_WAIT)))


def archive_states(attempts: DataFrame, most: int = MOST_TRIES, first_wait: int = FIRST_WAIT) -> DataFrame:
    """``path, tries, last_try, next_try, state, reason`` of each archive in the ledger.

    ``tries`` counts the failed ones since the archive last worked; ``state`` is ``waiting``, ``set aside``
    after ``most`` tries, or ``done``. ``next_try`` is null unless it waits.
    """
    worked = F.max(F.when(F.col("reason").isNull(), F.col("tried_at")))
    last = attempts.groupBy("path").agg(worked.alias("worked"))
    failed = attempts.filter("reason is not null").join(last, "path")
    failed = failed.filter(F.col("worked").isNull() | (F.col("tried_at") > F.col("worked")))
    since = failed.groupBy("path").agg(
        F.count("*").cast("int").alias("tries"),
        F.max("tried_at").alias("last_failure"),
        F.max_by("reason", "tried_at").alias("reason"),
    )
    state = F.when(F.col("tries").isNull(), "done").when(F.col("tries") >= most, "set aside").otherwise("waiting")
    later = F.timestamp_seconds(F.unix_micros("last_failure") / 1e6 + _wait(F.col("tries"), first_wait))
    known = last.join(since, "path", "left").withColumn("state", state)
    return known.select(
        "path",
        F.coalesce("tries", F.lit(0)).alias("tries"),
        F.coalesce("last_failure", "worked").alias("last_try"),
        F.when(F.col("state") == "waiting", later).alias("next_try"),
        "state",
        "reason",
    )


def due(states: DataFrame, now: Column) -> DataFrame:
    """Paths whose next try has come."""
    return states.filter((F.col("state") == "waiting") & (F.col("next_try") <= now)).select("path")


def record_attempts(tried: DataFrame, ledger: str, batch: str | int) -> None:
    """The tries ``path, tried_at, reason`` of a batch; the same batch again replaces its own."""
    rows = tried.select("path", F.col("tried_at").cast("timestamp").alias("tried_at"), F.col("reason").cast("string").alias("reason"))
    rows.write.mode("overwrite").parquet(f"{ledger.rstrip('/')}/batch={batch}")
