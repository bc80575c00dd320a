"""Approximate nearest neighbours by an inverted file with product quantisation.

Vectors are put into cells around trained centres; the table of an index is partitioned by cell, so a search
opens the folders of the cells nearest to its queries and no others. Within a cell a vector is told apart by the
codes of its residual's parts (Jegou, Douze and Schmid, 2011): the score of a row is the sum of partial products
looked up by code. The best ``refine * k`` rows of a block by these sums are then scored exactly.

The model is fitted on at most ``sample`` vectors (chosen by hash, over all rows) and has a fixed size, whatever
the table's; every row is indexed. For a filtered search the counts of each filter value in each cell, written
beside the table, tell which cells hold the value at all: of those the nearest are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagevane.operators.nearest import SCORE_DECIMALS, best, matrix, meet, to_blocks, top_k

SAMPLE = 20_000
CELLS = 64
PART = 8
CODES = 256
ROUNDS = 12
SEED = 11
PROBES = 8
REFINE = 10
# Bytes of queries, once for each cell that they probe, that are broadcast at most.
SMALL_BYTES = 32 << 20
BLOCK_ROWS = 4096
QUERY_ROWS = 512


@dataclass(frozen=True)
class CellModel:
    """Centres of cells, and for each part of a residual the vectors that its codes stand for."""

    centres: np.ndarray
    books: np.ndarray

    @property
    def dim(self) -> int:
        return self.centres.shape[1]

    def _padded(self, vectors: np.ndarray) -> np.ndarray:
        parts, _, width = self.books.shape
        out = np.zeros((len(vectors), parts * width))
        out[:, : vectors.shape[1]] = vectors
        return out.reshape(len(vectors), parts, width)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        return _nearest(vectors, self.centres)

    def codes(self, vectors: np.ndarray, cells: np.ndarray) -> np.ndarray:
        parts = self._padded(vectors - self.centres[cells])
        return np.stack([_nearest(parts[:, p], book) for p, book in enumerate(self.books)], 1).astype(np.uint8)

    def scores(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Estimated products of queries with the rows of a cell, from tables of partial products."""
        parts = self._padded(queries)
        out = np.repeat((queries @ self.centres[cell])[:, None], len(codes), 1)
        for p, book in enumerate(self.books):
            out += (parts[:, p] @ book.T)[:, codes[:, p]]
        return out


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1)[None] - 2 * vectors @ centres.T, axis=1)


def _centres(vectors: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's rounds from distinct sampled vectors; an empty centre moves to the vector farthest from its own."""
    distinct = np.unique(vectors, axis=0)
    count = max(1, min(count, len(distinct)))
    centres = distinct[rng.choice(len(distinct), count, replace=False)] if len(distinct) else np.zeros((1, vectors.shape[1]))
    for _ in range(ROUNDS if len(vectors) else 0):
        own = _nearest(vectors, centres)
        sizes = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, vectors)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
        empty = np.flatnonzero(sizes == 0)
        if len(empty):
            far = np.argsort(-((vectors - centres[own]) ** 2).sum(1))[: len(empty)]
            centres[empty[: len(far)]] = vectors[far]
    return centres


def train_cells(
    df: DataFrame, key: str, vector: str = "embedding", cells: int = CELLS, sample: int = SAMPLE, seed: int = SEED
) -> CellModel:
    """Fits centres and code books on the ``sample`` rows with the smallest hashes of their keys."""
    order = F.xxhash64(F.col(key), F.lit(seed))
    chosen = df.filter(F.col(vector).isNotNull()).select(F.col(vector).cast("array<double>").alias("v"), order.alias("o"))
    rows = chosen.orderBy("o").limit(sample).select("v").toArrow().column(0).combine_chunks()
    vectors = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1) if len(rows) else np.zeros((0, 1))
    rng = np.random.default_rng(seed)
    centres = _centres(vectors, cells, rng)
    rest = vectors - centres[_nearest(vectors, centres)]
    parts = -(-vectors.shape[1] // PART)
    padded = np.zeros((len(rest), parts * PART))
    padded[:, : rest.shape[1]] = rest
    split = padded.reshape(len(rest), parts, PART)
    books = np.zeros((parts, CODES, PART))
    for p in range(parts):
        book = _centres(split[:, p], CODES, rng)
        # Codes that aren't needed repeat the first one.
        books[p] = np.concatenate([book, np.repeat(book[:1], CODES - len(book), axis=0)])
    return CellModel(centres, books)


# --- the table ------------------------------------------------------------------------------


def _in_cells(df: DataFrame, model: CellModel, vector: str) -> DataFrame:
    """Rows with ``cell`` and ``codes``; rows without a vector aren't in the index."""
    schema = T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("codes", T.BinaryType())])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(vector)))
            if not batch.num_rows:
                continue
            lengths = pc.unique(pc.list_value_length(batch.column(vector))).to_pylist()
            if lengths != [shared.value.dim] or batch.column(vector).flatten().null_count:
                raise ValueError(f"vectors of lengths {lengths} or with nulls, centres of {shared.value.dim}")
            rows = batch.column(vector).flatten().to_numpy().astype(np.float64).reshape(batch.num_rows, -1)
            cells = shared.value.cells(rows)
            codes = shared.value.codes(rows, cells)
            columns = [pa.array(cells, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "cell", "codes"])

    return df.mapInArrow(place, schema)


def append_cells(
    df: DataFrame, path: str, model: CellModel, load: str | int, key: str, vector: str = "embedding", filter_on: str | None = None
) -> None:
    """Adds one load to the index at ``path``; writing the same load again replaces it.

    ``rebalance`` evens out files by size and so splits a crowded cell; rows of a file are in order of the filter.
    """
    columns = [key, vector, *([filter_on] if filter_on else [])]
    placed = _in_cells(df.select(*columns), model, vector)
    order = ["cell", *([filter_on] if filter_on else []), key]
    rows = placed.hint("rebalance", "cell").sortWithinPartitions(*order)
    folder = path.rstrip("/")
    rows.write.mode("overwrite").partitionBy("cell").parquet(f"{folder}/rows/load={load}")
    fields = [df.schema[c] for c in columns] + [T.StructField("cell", T.IntegerType())]
    stored = df.sparkSession.read.schema(T.StructType(fields)).parquet(f"{folder}/rows/load={load}")
    value = F.col(filter_on) if filter_on else F.lit(None).cast("int")
    counts = stored.groupBy(F.col("cell").cast("int").alias("cell"), value.alias("value")).agg(F.count("*").alias("n"))
    counts.write.mode("overwrite").parquet(f"{folder}/counts/load={load}")


def read_cells(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All loads: the indexed columns (``schema``), ``codes``, and the partition columns ``load`` and ``cell``."""
    fields = [T.StructField("codes", T.BinaryType()), T.StructField("load", T.StringType()), T.StructField("cell", T.IntegerType())]
    return spark.read.schema(T.StructType([*schema.fields, *fields])).parquet(f"{path.rstrip('/')}/rows")


# --- search -----------------------------------------------------------------------------------


class CellSearch:
    """An index at ``path`` with its model; ``key``, ``vector`` and ``filter_on`` as it was written with."""

    def __init__(
        self, spark: SparkSession, path: str, model: CellModel, schema: T.StructType, key: str = "vec_id",
        vector: str = "embedding", filter_on: str | None = None,
    ):
        columns = [schema[c] for c in dict.fromkeys([key, vector, *([filter_on] if filter_on else [])])]
        self.spark, self.path, self.model = spark, path.rstrip("/"), model
        self.key, self.vector, self.filter_on = key, vector, filter_on
        self.rows = read_cells(spark, path, T.StructType(columns))

    def counts(self) -> DataFrame:
        value = self.rows.schema[self.filter_on].dataType if self.filter_on else T.IntegerType()
        fields = [T.StructField("cell", T.IntegerType()), T.StructField("value", value), T.StructField("n", T.LongType())]
        return self.spark.read.schema(T.StructType(fields)).parquet(f"{self.path}/counts")

    def probes(self, queries: DataFrame, query_id: str, query_vector: str, match_on: str | None, n: int) -> DataFrame:
        """``query_id, query_vector, cell`` (and the value): the n nearest cells that hold rows, or rows of the value."""
        model = self.spark.sparkContext.broadcast(self.model.centres)

        @F.arrow_udf("array<double>")
        def distances(vectors: pa.Array) -> pa.Array:
            centres = model.value
            rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
            far = (centres**2).sum(1)[None] - 2 * rows @ centres.T
            return pa.array(list(far), pa.list_(pa.float64()))

        asked = queries.select(query_id, query_vector, *([match_on] if match_on else []))
        asked = asked.filter(F.col(query_vector).isNotNull())
        pairs = asked.select("*", F.posexplode(distances(query_vector)).alias("cell", "far"))
        held = self.counts().groupBy("cell", *(["value"] if match_on else [])).agg(F.sum("n").alias("n"))
        same = F.col("cell") == F.col("h_cell")
        if match_on:
            same &= F.col(match_on) == F.col("h_value")
        held = held.select(*(F.col(c).alias(f"h_{c}") for c in held.columns))
        near = pairs.join(held, same).selectExpr(
            "*", f"row_number() over (partition by `{query_id}` order by far, cell) as place"
        ).filter(F.col("place") <= n)
        return near.select(*asked.columns, "cell", F.col("h_n").alias("held"))

    def found(
        self, queries: DataFrame, k: int = 10, query_id: str = "query_id", query_vector: str = "query_vector",
        match_on: str | None = None, probes: int = PROBES, refine: int = REFINE, small_bytes: int = SMALL_BYTES,
    ) -> DataFrame:
        """``query_id, key, score, rank``: about the k rows with the largest products; scores are exact.

        ``match_on`` names the queries' column that must equal the index's filter. ``query_id`` is unique.
        """
        chosen = self.probes(queries, query_id, query_vector, match_on, probes)
        limit = max(1, small_bytes // (8 * self.model.dim + 64))
        head = chosen.limit(limit + 1).toArrow()
        few = head.num_rows <= limit
        rows = self.rows
        if few:
            # Known cells prune the table's folders.
            rows = rows.filter(F.col("cell").isin(*set(head.column("cell").to_pylist())))
            chosen = self.spark.createDataFrame(head, chosen.schema).coalesce(1)
        else:
            chosen = chosen.repartition("cell")
        asked = _blocked(chosen, query_id, query_vector, match_on, None, QUERY_ROWS)
        corpus = _blocked(rows, self.key, self.vector, self.filter_on if match_on else None, "codes", BLOCK_ROWS)
        scored = self._scored(meet(corpus, asked, few), queries.schema[query_id], k, refine)
        return top_k(scored, query_id, self.key, k)

    def share_read(self, queries: DataFrame, **how) -> float:
        """Rows in the cells that each query probes, as a mean share of the table."""
        total = self.counts().agg(F.sum("n")).first()[0]
        per_cell = self.counts().groupBy("cell").agg(F.sum("n").alias("rows"))
        found = self.probes(queries, **how).join(per_cell, "cell")
        asked = found.groupBy(how["query_id"]).agg(F.sum("rows").alias("rows"))
        return asked.agg(F.avg("rows")).first()[0] / total

    def _scored(self, met: DataFrame, query_id: T.StructField, k: int, refine: int) -> DataFrame:
        out = T.StructType([query_id, self.rows.schema[self.key], T.StructField("score", T.DoubleType())])
        names = out.fieldNames()
        shared = self.spark.sparkContext.broadcast(self.model)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    ids, asked = batch.column("ids")[i].values, batch.column("q_ids")[i].values
                    vectors = matrix(batch.column("flat")[i], len(ids))
                    wanted = matrix(batch.column("q_flat")[i], len(asked))
                    codes = np.frombuffer(b"".join(batch.column("extra")[i].as_py()), np.uint8).reshape(len(ids), -1)
                    about = shared.value.scores(wanted, int(batch.column("grp")[i].as_py().split(" ")[0]), codes)
                    query, row = best(about, np.arange(len(ids)), k * refine, np.full(len(asked), -np.inf))
                    exact = np.round(np.einsum("ij,ij->i", wanted[query], vectors[row]), SCORE_DECIMALS)
                    yield pa.RecordBatch.from_arrays([asked.take(pa.array(query)), ids.take(pa.array(row)), pa.array(exact)], names)

        return met.select("grp", "ids", "flat", "extra", "q_ids", "q_flat").mapInArrow(score, out)


def _blocked(df: DataFrame, key: str, vector: str, value: str | None, codes: str | None, rows: int) -> DataFrame:
    """Blocks of one cell and value each, whose ``grp`` begins with the cell."""
    chosen = df.filter(F.col(value).isNotNull()) if value else df
    group = F.concat_ws(" ", F.col("cell").cast("string"), *([F.col(value).cast("string")] if value else []))
    chosen = chosen.select(group.alias("_grp"), key, vector, *([codes] if codes else []))
    return to_blocks(chosen, key, vector, "_grp", codes, rows)
