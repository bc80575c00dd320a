"""Which messages an index has, by load: repeats are told by key, however long ago they came.

``<path>/load=L`` holds the keys of one load. Keys of a batch are looked up in the other loads: the batch's keys
are the smaller side, so they are what Spark broadcasts, and only keys that both sides have travel further. A
load never meets its own keys, so a replay keeps what it kept before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "_seen_key"


def seen_path(index: str) -> str:
    return f"{index.rstrip('/')}_seen"


def keyed(df: DataFrame, *fields: str) -> DataFrame:
    """``df`` with a hash of its fields that tells null from empty."""
    return df.withColumn(KEY, F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256))


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{KEY} string, load string").parquet(path)


def unseen(df: DataFrame, path: str, load: str | int, *fields: str) -> DataFrame:
    """One row for each key of ``df`` that no other load has, with the key.

    Of rows with equal keys, which are equal in ``fields``, one stays.
    """
    once = keyed(df, *fields).dropDuplicates([KEY])
    if not _exists(df.sparkSession, path):
        return once
    others = read_seen(df.sparkSession, path).filter(F.col("load") != str(load)).select(KEY)
    known = others.join(once.select(KEY), KEY, "left_semi").distinct()
    return once.join(known, KEY, "left_anti")


def remember(rows: DataFrame, path: str, load: str | int) -> None:
    """Keys of the rows that a load has indexed, once they are; the same load again replaces its own."""
    rows.select(KEY).write.mode("overwrite").parquet(f"{path.rstrip('/')}/load={load}")


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
