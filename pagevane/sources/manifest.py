"""Lists of archive paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagevane.functions.text import local_key, resolve_path, strip


def read_manifest(spark: SparkSession, path: str, prefix: str | None = None) -> DataFrame:
    """One archive per line: ``warc_url, path, local_key``; blank lines are dropped.

    ``prefix`` is where the archives are stored; by default the public crawl host.
    """
    lines = spark.read.text(path).select(strip("value").alias("warc_url"))
    return with_paths(lines.filter("warc_url <> ''"), prefix)


def with_paths(manifest: DataFrame, prefix: str | None = None) -> DataFrame:
    full = resolve_path("warc_url") if prefix is None else resolve_path("warc_url", prefix)
    return manifest.select("*", full.alias("path"), local_key("warc_url").alias("local_key"))
