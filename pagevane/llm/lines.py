"""Line dedup by distinct-site spread, in DataFrame functions only.

A line is what stands between newlines; lines are equal when they are without spaces at both
ends. The sites of a line are summarised by a HyperLogLog sketch that tasks make before the
shuffle and that is merged after it, so that a line of a million rows costs no more than one of
two. Lines whose estimate lies within the sketch's error of the threshold get an exact count of
distinct sites. What reaches the threshold is boilerplate: it stays where it occurs first (smallest
id, then place) and goes everywhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

MIN_SITES = 8
# Sketch of 2 ** 10 registers: relative standard error of about 3.3 %.
LOG_REGISTERS = 10
# Estimates within this share of the threshold are counted exactly: over five standard errors.
MARGIN = 0.18
SALTS = 16


def _key(line: Column) -> Column:
    """Two independent hashes, 96 bits, of a line as it is compared; null for a blank line."""
    plain = F.trim(line)
    return F.when(plain != "", F.struct(F.xxhash64(plain).alias("k1"), F.hash(plain).alias("k2")))


def line_rows(rows: DataFrame) -> DataFrame:
    """``id, twin, site, pos, k1, k2`` of each line that isn't blank."""
    lines = rows.select("id", "twin", "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.select("id", "twin", "site", "pos", _key(F.col("line")).alias("k")).filter("k is not null").select(
        "id", "twin", "site", "pos", "k.*"
    )


def _spread_over_salts(keys: DataFrame) -> DataFrame:
    """Each key once for each salt: a frequent line's rows meet it in as many groups."""
    return keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _salted(lines: DataFrame) -> DataFrame:
    return lines.withColumn("salt", F.pmod(F.xxhash64("id", "pos"), F.lit(SALTS)).cast("int"))


def frequent(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The lines with ``min_sites`` rows or more: no other line can be on as many sites."""
    often = lines.groupBy("k1", "k2").agg(F.count("site").alias("n")).filter(F.col("n") >= min_sites)
    keys = _spread_over_salts(often.select("k1", "k2"))
    return _salted(lines).join(keys, ["k1", "k2", "salt"], "left_semi")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``k1, k2, sites, first`` of the lines on ``min_sites`` sites or more; a null is no site."""
    sketches = lines.groupBy("k1", "k2").agg(
        F.hll_sketch_agg("site", F.lit(LOG_REGISTERS)).alias("sketch"),
        F.min(F.struct("id", "twin", "pos")).alias("first"),
    )
    spread = written(sketches.select("k1", "k2", "first", F.hll_sketch_estimate("sketch").alias("estimate")))
    near = spread.filter(F.abs(F.col("estimate") - min_sites) <= MARGIN * min_sites)
    near = _spread_over_salts(near.select("k1", "k2"))
    exact = lines.filter("site is not null").join(near, ["k1", "k2", "salt"], "left_semi")
    exact = exact.groupBy("k1", "k2", "site").agg(F.count("*")).groupBy("k1", "k2").agg(F.count("*").alias("exact"))
    sites = spread.join(exact, ["k1", "k2"], "left")
    return sites.select("k1", "k2", F.coalesce("exact", "estimate").alias("sites"), "first").filter(
        F.col("sites") >= min_sites
    )


def without_boilerplate(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """``row, n_lines, n_removed, kept``: each row of ``docs`` as a struct, and the text that stays.

    Kept lines are joined by newlines as they were. Null text: empty, one blank line. Blank
    lines stay. Rows with a null id lose and cause nothing. Rows of one id are told apart by
    their text (``twin`` is its hash); equal rows lose the same lines.
    """
    rows = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        docs[id].alias("id"),
        text_of(docs[text]).alias("text"),
        docs[site].alias("site"),
    )
    rows = rows.withColumn("twin", F.xxhash64("text"))
    lines = written(frequent(line_rows(rows.filter("id is not null")), min_sites))
    known = _spread_over_salts(written(boilerplate(lines, min_sites)).select("k1", "k2", "first"))
    gone = lines.join(known, ["k1", "k2", "salt"]).filter(F.struct("id", "twin", "pos") != F.col("first"))
    gone = gone.groupBy("id", "twin").agg(F.collect_set("pos").alias("gone"))
    both = rows.join(gone, ["id", "twin"], "left")
    split = F.split("text", "\n")
    places = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(places, lambda i: F.get(F.col("lines"), i)), "\n")
    )
    return both.withColumn("lines", split).select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        kept.alias("kept"),
    )


def line_digest(docs: DataFrame, id: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """``id, n_lines, n_removed, kept_sha256`` of each row (see ``without_boilerplate``)."""
    rows = without_boilerplate(docs, id, text, site)
    return rows.select(F.col("row")[id].alias(id), "n_lines", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


# The same rows in DuckDB.
SQL = f"""
WITH lines AS (
  SELECT doc_id, source, pos, line, trim(line, ' ') AS k
  FROM (SELECT doc_id, source, unnest(range(len(l))) AS pos, unnest(l) AS line
        FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
),
spread AS (
  SELECT k, count(DISTINCT source) AS sites, min(struct_pack(d := doc_id, p := pos)) AS f
  FROM lines WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= {MIN_SITES}
),
marked AS (
  SELECT doc_id, pos, line, f IS NOT NULL AND struct_pack(d := doc_id, p := pos) <> f AS gone
  FROM lines LEFT JOIN spread USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
