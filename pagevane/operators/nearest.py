"""Nearest neighbours over a column of unit vectors, exact and by random projections.

Vectors have unit length, so the order by inner product is also that of cosine and Euclidean distance.

One plan serves any number of queries. Both sides become blocks of vectors, keyed by what they must agree in
(a filter's value, or nothing); blocks that meet in an equi-join are multiplied as matrices in the task, which
passes on at most k rows for each query and block, and Spark's window keeps the best k. A query set of at most
``SMALL`` rows is broadcast, and the corpus stays where it is; of a larger one each block is sent to all salts,
and the corpus is dealt over the salts once, so that no value, however common, is one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagevane.functions.text import let
from pagevane.functions.vectors import dot

# Scores are compared after rounding to this many decimals, so that equal vectors
# tie (and the smaller id wins) whatever order the products were added in.
SCORE_DECIMALS = 9
# Largest query set that is broadcast (about 12 MB at 384 dimensions).
SMALL = 4096
# Vectors of a block.
BLOCK_ROWS = 4096
# Cells of one score matrix inside a task (32 MB of doubles).
BLOCK_CELLS = 4_000_000
# Query blocks whose k-th best scores a task remembers, to pass on fewer rows.
FLOORS = 64


def top_k(scored: DataFrame, query_id: str, key: str, k: int, *ties: str) -> DataFrame:
    """First k rows per query, equal scores by ``key`` (and ``ties``); Spark cuts each partition to k rows before the shuffle."""
    order = Window.partitionBy(query_id).orderBy(F.desc("score"), F.asc(key), *map(F.asc, ties))
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("bigint"))
    return ranked.filter(F.col("rank") <= k)


# --- blocks ---------------------------------------------------------------------------


def to_blocks(
    df: DataFrame, key: str, vector: str, group: str | None = None, extra: str | None = None, rows: int = BLOCK_ROWS
) -> DataFrame:
    """Rows as blocks ``grp, ids, flat`` (vectors end to end), and ``extra`` likewise, within the input's tasks.

    ``extra`` is a column of arrays of one length, or of single values.
    A block holds rows of one value of ``group``; rows without a value agree with nothing and are left out, as are
    rows without a vector. Vectors that hold nulls, or differ in length within a batch, are an error.
    """
    kinds = {"grp": df.schema[group].dataType if group else T.IntegerType()}
    kinds |= {"ids": T.ArrayType(df.schema[key].dataType), "flat": df.schema[vector].dataType}
    if extra:
        kind = df.schema[extra].dataType
        kinds["extra"] = kind if isinstance(kind, T.ArrayType) else T.ArrayType(kind)
    schema = T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table.filter(pc.is_valid(table.column(vector)))
            if group:
                table = table.filter(pc.is_valid(table.column(group))).sort_by(group)
            if not table.num_rows:
                continue
            yield _as_blocks(table.combine_chunks(), key, vector, group, extra, rows)

    columns = dict.fromkeys([key, vector, *filter(None, [group, extra])])
    return df.select(*columns).mapInArrow(build, schema)


def _as_blocks(
    table: pa.Table, key: str, vector: str, group: str | None, extra: str | None, rows: int
) -> pa.RecordBatch:
    def column(name: str) -> pa.Array:
        return table.column(name).chunk(0)

    lengths = pc.unique(pc.list_value_length(column(vector))).to_pylist()
    if len(lengths) != 1 or column(vector).flatten().null_count:
        raise ValueError(f"vectors of lengths {lengths} or with nulls")
    firsts = np.zeros(1, np.int64)
    if group:
        codes = column(group).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        firsts = np.concatenate([firsts, np.flatnonzero(np.diff(codes)) + 1])
    edges = [*firsts, table.num_rows]
    at = np.concatenate([np.arange(x, y, rows) for x, y in zip(edges, edges[1:])] + [[table.num_rows]])
    groups = column(group).take(pa.array(at[:-1])) if group else pa.array(np.zeros(len(at) - 1, np.int32))

    def lists(values: pa.Array, width: int) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(at * width, pa.int32()), values)

    columns = [groups, lists(column(key), 1), lists(column(vector).flatten(), lengths[0])]
    names = ["grp", "ids", "flat"]
    if extra:
        nested = pa.types.is_list(column(extra).type)
        width = pc.list_value_length(column(extra))[0].as_py() if nested else 1
        columns.append(lists(column(extra).flatten() if nested else column(extra), width))
        names.append("extra")
    return pa.RecordBatch.from_arrays(columns, names)


def meet(corpus: DataFrame, queries: DataFrame, small: bool) -> DataFrame:
    """Blocks of both sides that share ``grp``; columns of queries begin with ``q_``."""
    asked = queries.select(*(F.col(c).alias(f"q_{c}") for c in queries.columns))
    if small:
        return corpus.join(F.broadcast(asked), F.col("grp") == F.col("q_grp"))
    salts = int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = asked.withColumn("q_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = corpus.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    return salted.join(spread, (F.col("grp") == F.col("q_grp")) & (F.col("salt") == F.col("q_salt")))


def matrix(row: pa.Scalar, n: int, dtype=np.float64) -> np.ndarray:
    return row.values.to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(n, -1)


def best(scores: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the k best of each row, smaller ids first among equals, none below ``floor``; raises ``floor``."""
    keep = min(k, scores.shape[1])
    kth = -np.partition(-scores, keep - 1, axis=1)[:, keep - 1]
    least = np.maximum(kth, floor)
    query, row = np.nonzero((scores >= least[:, None]) & np.isfinite(scores))
    if keep == k:
        np.maximum(floor, kth, out=floor)
    order = np.lexsort((ids[row], -scores[query, row], query))
    query, row = query[order], row[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    return query[place < k], row[place < k]


def scored_blocks(
    met: DataFrame, key: T.StructField, query_id: T.StructField, k: int, masked: bool = False
) -> DataFrame:
    """``query_id, key, score``: at most k rows for each query and pair of blocks that met.

    With ``masked`` rows and queries are compared only where one of their ``extra`` numbers, place by place, is equal.
    """
    out = T.StructType([query_id, key, T.StructField("score", T.DoubleType())])
    names = out.fieldNames()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                ids, asked = batch.column("ids")[i].values, batch.column("q_ids")[i].values
                vectors = matrix(batch.column("flat")[i], len(ids))
                wanted = matrix(batch.column("q_flat")[i], len(asked))
                if vectors.shape[1] != wanted.shape[1]:
                    raise ValueError(f"vectors of length {vectors.shape[1]}, queries of {wanted.shape[1]}")
                mine = theirs = None
                if masked:
                    theirs = matrix(batch.column("q_extra")[i], len(asked), np.int64)
                    mine = matrix(batch.column("extra")[i], len(ids), np.int64)
                    near = np.logical_or.reduce([np.isin(a, b) for a, b in zip(mine.T, theirs.T)])
                    ids, vectors, mine = ids.filter(pa.array(near)), vectors[near], mine[near]
                asking = f"{batch.column('grp')[i]} {asked.to_pylist()}".encode()
                name = hashlib.blake2b(asking + wanted.tobytes()).digest()
                if name not in floors and len(floors) == FLOORS:
                    floors.pop(next(iter(floors)))
                floor = floors.setdefault(name, np.full(len(asked), -np.inf))
                step = max(1, BLOCK_CELLS // len(asked))
                for at in range(0, len(ids), step):
                    scores = np.round(wanted @ vectors[at : at + step].T, SCORE_DECIMALS)
                    if masked:
                        shared = np.zeros(scores.shape, bool)
                        for a, b in zip(theirs.T, mine[at : at + step].T):
                            shared |= a[:, None] == b[None, :]
                        scores[~shared] = -np.inf
                    some = ids.slice(at, step)
                    query, row = best(scores, _plain(some), k, floor)
                    if len(query):
                        columns = [asked.take(pa.array(query)), some.take(pa.array(row)), pa.array(scores[query, row])]
                        yield pa.RecordBatch.from_arrays(columns, names)

    columns = ["grp", "ids", "flat", "q_ids", "q_flat", *(["extra", "q_extra"] if masked else [])]
    return met.select(*columns).mapInArrow(score, out)


def _plain(ids: pa.Array) -> np.ndarray:
    values = ids.to_numpy(zero_copy_only=False)
    return values.astype(str) if values.dtype == object else values


def query_blocks(queries: DataFrame, key: str, vector: str, small: int, *more: str, **how) -> tuple[DataFrame, bool]:
    """Queries as blocks, and whether they are at most ``small``; a small set is computed once, and is one task."""
    chosen = queries.select(key, vector, *dict.fromkeys(more))
    head = chosen.limit(small + 1).toArrow()
    few = head.num_rows <= small
    if few:
        chosen = queries.sparkSession.createDataFrame(head, chosen.schema).coalesce(1)
    return to_blocks(chosen, key, vector, rows=1024, **how), few


# --- exact search -----------------------------------------------------------------------


def knn_exact(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    match_on: str | None = None,
    max_queries: int = SMALL,
) -> DataFrame:
    """The k corpus rows with the largest inner product per query, exactly.

    ``match_on`` names a column of both sides that must be equal (a filtered search with its own filter value
    per query): blocks of other values never meet. Up to ``max_queries`` queries are broadcast; more are
    dealt with the corpus. Result: ``query_id, key, score, rank``.
    """
    more = filter(None, [match_on])
    asked, few = query_blocks(queries, query_id, query_vector, max_queries, *more, group=match_on)
    met = meet(to_blocks(corpus, key, vector, match_on), asked, few)
    return top_k(scored_blocks(met, corpus.schema[key], queries.schema[query_id], k), query_id, key, k)


def knn_single(
    corpus: DataFrame,
    query: Sequence[float],
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The k nearest rows to one vector: a scan that keeps k rows per task."""
    q = F.array(*[F.lit(float(x)) for x in query])
    score = F.round(dot(F.col(vector), q), SCORE_DECIMALS).alias("score")
    return corpus.select(key, score).orderBy(F.desc("score"), F.asc(key)).limit(k)


# --- approximate search -------------------------------------------------------------

BUCKET_LENGTH = 0.5
TABLES = 16
# Projections that form one bucket. More of them make buckets smaller, more tables
# make up for the neighbours that smaller buckets miss.
PER_TABLE = 4
SEED = 42


def _as_vector(c: str) -> Column:
    return array_to_vector(F.col(c).cast("array<double>"))


def lsh_model(
    corpus: DataFrame,
    vector: str = "embedding",
    bucket_length: float = BUCKET_LENGTH,
    tables: int = TABLES,
    per_table: int = PER_TABLE,
    seed: int = SEED,
) -> BucketedRandomProjectionLSHModel:
    """Random projections for Euclidean distance; fitting reads the dimension only."""
    lsh = BucketedRandomProjectionLSH(
        inputCol="_vector",
        outputCol="_hashes",
        bucketLength=bucket_length,
        numHashTables=tables * per_table,
        seed=seed,
    )
    return lsh.fit(corpus.select(_as_vector(vector).alias("_vector")))


def lsh_index(
    df: DataFrame,
    model: BucketedRandomProjectionLSHModel,
    vector: str = "embedding",
    per_table: int = PER_TABLE,
    name: str = "hashes",
) -> DataFrame:
    """Add the bucket of each hash table as ``array<bigint>``.

    A bucket is the combination of ``per_table`` projections (Datar et al., SCG
    2004). The column can be stored with the vectors.
    """
    hashed = model.transform(df.withColumn("_vector", _as_vector(vector)))
    tables = model.getOrDefault("numHashTables") // per_table
    # Each projection comes as a vector of length one.
    steps = F.transform("_hashes", lambda h: vector_to_array(h)[0].cast("bigint"))

    def bucket(steps: Column, t: Column) -> Column:
        return F.xxhash64(F.slice(steps, t * per_table + 1, F.lit(per_table)))

    buckets = let(
        steps, lambda s: F.transform(F.sequence(F.lit(0), F.lit(tables - 1)), lambda t: bucket(s, t))
    )
    return hashed.withColumn(name, buckets).drop("_vector", "_hashes")


def knn_lsh(
    indexed: DataFrame,
    queries: DataFrame,
    model: BucketedRandomProjectionLSHModel,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    per_table: int = PER_TABLE,
    max_queries: int = SMALL,
) -> DataFrame:
    """Approximate nearest neighbours: exact scores of the rows that share a bucket.

    ``indexed`` comes from ``lsh_index``. As in the exact search blocks of vectors meet blocks of queries; rows
    that share no bucket with any query of a block are dropped before anything is multiplied, so a crowded
    bucket is worked on by all tasks that hold its rows. No candidate is left out.
    """
    hashes = "hashes"
    probes = lsh_index(queries.select(query_id, query_vector), model, query_vector, per_table)
    asked, few = query_blocks(probes, query_id, query_vector, max_queries, hashes, extra=hashes)
    met = meet(to_blocks(indexed, key, vector, extra=hashes), asked, few)
    found = scored_blocks(met, indexed.schema[key], probes.schema[query_id], k, masked=True)
    return top_k(found, query_id, key, k)
