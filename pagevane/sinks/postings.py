"""The inverted index beside the index table: written once for each load, read by the terms of a search.

``<path>/blocks/load=L/bucket=B`` holds blocks of at most ``BLOCK`` postings of one term. Within a load the
postings of a term are in order of impact (frequency, then shortness of the text), so that a block's largest
frequency and smallest length bound what it can add to a score, and most blocks of a common term can be
skipped unread. ``bucket`` is a hash of the term; files are sorted by term inside, so a search opens the folders
of its terms and the row groups around them. ``<path>/sizes/load=L`` has the numbers of texts, words and buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagevane.functions.text import let, tokens

BLOCK = 128
# Folders of a load. A load of very many texts wants more; each load may have its own number.
BUCKETS = 16


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def postings_path(index: str) -> str:
    """Where the postings of an index table go, beside it."""
    return f"{index.rstrip('/')}_postings"


def block_schema(key: T.DataType) -> T.StructType:
    entry = T.StructType([
        T.StructField("doc", T.LongType()), T.StructField("key", key),
        T.StructField("tf", T.IntegerType()), T.StructField("length", T.IntegerType()),
    ])
    numbers = [T.StructField(name, T.IntegerType()) for name in ("n", "max_tf", "min_length")]
    return T.StructType([T.StructField("term", T.StringType()), *numbers, T.StructField("entries", T.ArrayType(entry))])


def term_counts(terms: str) -> Column:
    """``term, tf`` of each distinct term of a sorted array, within the row."""
    ends = F.transform(
        terms, lambda t, i: F.when(F.coalesce(F.get(F.col(terms), i + 1) != t, F.lit(True)), i + 1)
    )
    return let(
        F.filter(ends, lambda e: e.isNotNull()),
        lambda at: F.transform(at, lambda e, j: F.struct(
            F.get(F.col(terms), e - 1).alias("term"),
            (e - F.when(j == 0, 0).otherwise(F.get(at, j - 1))).cast("int").alias("tf"),
        )),
    )


def append_postings(
    df: DataFrame, path: str, load: str | int, key: str = "url", text: str = "h1", buckets: int = BUCKETS
) -> None:
    """Add the postings of one load; writing the same load again replaces it.

    Every row is a text of its own, also where keys are equal. Postings are dealt by ranges of (bucket, term,
    impact), so a term of very many texts is spread over tasks; no term is gathered.
    """
    analysed = df.select(
        F.monotonically_increasing_id().alias("doc"), F.col(key).alias("key"),
        F.inline(F.array(F.struct(F.array_sort(tokens(text)).alias("terms")))),
    )
    counted = analysed.select("doc", "key", F.size("terms").alias("length"), F.inline(term_counts("terms")))
    order = [F.col("bucket"), F.col("term"), F.col("tf").desc(), F.col("length"), F.col("doc")]
    dealt = counted.withColumn("bucket", bucket_of(F.col("term"), buckets)).repartitionByRange(*order)
    columns = ["bucket", "term", "doc", "key", "tf", "length"]
    sorted_ = dealt.sortWithinPartitions(*order).select(*columns)
    schema = block_schema(df.schema[key].dataType)
    whole = T.StructType([T.StructField("bucket", T.IntegerType()), *schema.fields])
    blocks = sorted_.mapInArrow(_cut_blocks, whole)
    blocks.write.mode("overwrite").partitionBy("bucket").option("maxRecordsPerFile", 1_000_000).parquet(
        f"{path.rstrip('/')}/blocks/load={load}"
    )
    # Texts that are null are counted, but have no length. Words are those of the blocks just written.
    stored = df.sparkSession.read.schema(whole).parquet(f"{path.rstrip('/')}/blocks/load={load}")
    words = stored.agg(F.sum(F.aggregate("entries", F.lit(0).cast("long"), lambda n, e: n + e["tf"])).alias("words"))
    sizes = df.agg(F.count("*").alias("texts"), F.count(text).alias("measured"))
    sizes = sizes.withColumn("words", F.coalesce(words.scalar(), F.lit(0)).cast("long"))
    sizes = sizes.withColumn("buckets", F.lit(buckets))
    sizes.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/sizes/load={load}")


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one term in sorted batches, cut into blocks; a run that goes on in the next batch waits for it."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        firsts = _firsts(table)
        # The last run may go on; its whole blocks are ready.
        done = firsts[-1] + (table.num_rows - firsts[-1]) // BLOCK * BLOCK
        if done:
            yield _blocks(table.slice(0, done), firsts[firsts < done])
        held = table.slice(done)
    if held is not None and held.num_rows:
        yield _blocks(held, _firsts(held))


def _firsts(table: pa.Table) -> np.ndarray:
    """Where each term begins."""
    if not table.num_rows:
        return np.zeros(1, np.int64)
    codes = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1])


def _blocks(table: pa.Table, firsts: np.ndarray) -> pa.RecordBatch:
    table = table.combine_chunks()
    edges = np.concatenate([firsts, [table.num_rows]])
    starts = np.concatenate([np.arange(a, b, BLOCK) for a, b in zip(edges, edges[1:])])
    ends = np.concatenate([starts, [table.num_rows]])
    names = ["doc", "key", "tf", "length"]
    entry = pa.StructArray.from_arrays([_flat(table, c) for c in names], names)
    at = pa.array(starts)
    length = _flat(table, "length").to_numpy()
    columns = [
        _flat(table, "bucket").take(at), _flat(table, "term").take(at), pa.array(np.diff(ends), pa.int32()),
        _flat(table, "tf").take(at), pa.array(np.minimum.reduceat(length, starts), pa.int32()),
        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entry),
    ]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "term", "n", "max_tf", "min_length", "entries"])


def _flat(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def read_blocks(spark: SparkSession, path: str, key: T.DataType) -> DataFrame:
    """All loads; ``load`` and ``bucket`` are partition columns."""
    schema = block_schema(key).add("load", T.StringType()).add("bucket", T.IntegerType())
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/blocks")


def read_sizes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("texts long, measured long, words long, buckets int, load string").parquet(f"{path.rstrip('/')}/sizes")
