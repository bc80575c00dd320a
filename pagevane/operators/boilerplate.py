"""Blocks that a site repeats on most of its pages: menus, notices, teasers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_PAGES = 3
SHARE = 0.5
SALTS = 16


def site(url: Column | str) -> Column:
    """Host of a url in lower case; null where there is none."""
    return F.lower(F.try_parse_url(F.col(url) if isinstance(url, str) else url, F.lit("HOST")))


def drop_site_blocks(
    pages: DataFrame,
    key: str,
    url: str = "url",
    text: str = "text",
    min_pages: int = MIN_PAGES,
    share: float = SHARE,
    salts: int = SALTS,
) -> DataFrame:
    """Take the template blocks of each site out of ``text``; ``n_dropped`` counts them.

    A block is a line of ``text`` (see ``main_text``). It belongs to the template if it is on at least
    ``min_pages`` pages of the host and on ``share`` of them; repeats inside a page count once. Pages
    without a host belong to no site and stay as they are, as does a null text. All rows and
    columns are kept.

    Hashes of blocks are counted with a partial sum in the task that reads them. On average a page of a
    host has at most all its blocks in the template, so a template has at most 1 / ``share`` times the
    mean number of blocks of a page, and is kept as one array. Both joins on the host deal the rows of
    a host over ``salts`` tasks (by block, then by ``key``), so a host that holds a large share of all
    pages isn't one task. ``pages`` is read three times: give it a stored table where it is costly.
    """
    lines = F.split(text, "\n", -1)
    hashes = F.transform(F.filter(lines, lambda b: b != ""), lambda b: F.xxhash64(b))
    sited = pages.select(site(url).alias("_site"), hashes.alias("_blocks")).filter("_site IS NOT NULL")
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")

    counts = (
        sited.select("_site", F.explode(F.array_distinct("_blocks")).alias("_block"))
        .groupBy("_site", "_block")
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") >= min_pages)
        .withColumn("_salt", F.pmod("_block", F.lit(salts)).cast("int"))
    )
    sizes = sited.groupBy("_site").agg(F.count("*").alias("_size"))
    sizes = sizes.filter(F.col("_size") >= min_pages).select("*", every_salt)
    template = (
        counts.join(sizes, ["_site", "_salt"])
        .filter(F.col("_n") >= F.col("_size") * share)
        .groupBy("_site")
        .agg(F.collect_list("_block").alias("_template"))
        .select("*", every_salt)
    )

    salt = F.pmod(F.xxhash64(key), F.lit(salts)).cast("int")
    found = pages.withColumns({"_site": site(url), "_salt": salt}).join(
        template, ["_site", "_salt"], "left"
    )
    kept = F.filter(lines, lambda b: (b == "") | ~F.array_contains("_template", F.xxhash64(b)))
    cut = F.col("_template").isNotNull() & F.col(text).isNotNull()
    dropped = F.when(cut, F.size(lines) - F.size(kept)).otherwise(0).cast("long")
    rest = [c for c in pages.columns if c != text]
    left = F.when(cut, F.array_join(kept, "\n")).otherwise(F.col(text))
    return found.select(*rest, left.alias(text), dropped.alias("n_dropped"))
