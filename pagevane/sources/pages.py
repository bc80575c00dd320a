"""Tables of pages that were taken out of their archives before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Page rows with at least ``url`` and ``html``."""
    pages = spark.read.format(fmt).load(path)
    missing = {"url", "html"} - set(pages.columns)
    if missing:
        raise ValueError(f"not a page table, missing {sorted(missing)}")
    return pages


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Share a scan with fewer splits than cores out over all cores.

    A scan of many files has splits enough and is returned as it is; only a small
    input, where the copy is cheap, is shuffled ahead of heavy per-row work.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, key)
