"""Embedding near-dedup: a subspace pigeonhole join with exact verification.

For unit vectors a cosine of ``c`` is a squared distance of ``2 - 2c``. A rotation is cut into
blocks of few dimensions. The squared distance is the sum over the blocks, so that two near
vectors keep within a block's budget, its share of the squared distance in proportion to its
share of the variance, in at least one block: a union of range joins, one for each block, misses
no pair.

A range join lays a grid over the block's two widest directions. A vector stands in one cell and
is also sent to the neighbouring cells that its range reaches, on one side of an order of cells,
so that each pair meets once. Cells are cut into chunks of bounded size, and chunk meets chunk:
a crowded cell is many small tasks, none large. Inside, block distances leave few candidates,
which are verified on whole vectors in double precision.

Equal vectors form a class, of which one goes on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written
from .components import connected

COSINE = 0.98
BLOCKS = 8
CHUNK = 512
# Added to budgets, for rounding: candidates only, verification is exact.
SLACK = 1e-6


def _valid(vector: str):
    """Whether a vector can link: not null, not empty, all components finite, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _moments(vectors: DataFrame, dim: int) -> np.ndarray:
    """Covariance of the unit vectors: a matrix of ``dim * dim`` numbers, summed in the tasks."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1))
        for batch in batches:
            x = _unit(_matrix(batch.column(0)))
            x = np.hstack([x, np.ones((len(x), 1))])
            total += x.T @ x
        flat = total.ravel()
        places = pa.array(np.arange(len(flat), dtype=np.int32))
        yield pa.RecordBatch.from_arrays([places, pa.array(flat)], ["place", "value"])

    rows = vectors.mapInArrow(sums, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros((dim + 1) ** 2)
    for r in rows.collect():
        out[r["place"]] = r["value"]
    out = out.reshape(dim + 1, dim + 1)
    n = max(out[-1, -1], 1.0)
    mean = out[-1, :-1] / n
    return out[:-1, :-1] / n - np.outer(mean, mean)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that very small or large components don't under- or overflow.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class _Rotation:
    """Principal directions dealt out to blocks, so that the blocks are of about equal variance."""

    def __init__(self, covariance: np.ndarray, blocks: int, cosine: float):
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(values)[::-1]
        blocks = min(blocks, len(order))
        self.blocks = [order[b::blocks] for b in range(blocks)]
        self.vectors = vectors
        spread = np.array([max(values[b].sum(), 1e-12) for b in self.blocks])
        self.budgets = (2 - 2 * cosine) * spread / spread.sum() + SLACK

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        y = _unit(x) @ self.vectors
        return [y[:, b] for b in self.blocks]


def _cells(vectors: DataFrame, rotation: _Rotation) -> DataFrame:
    """``dim, label, block, x, y, home, class, part``: each vector in its cell and in those it reaches.

    Cells are twice the range wide. A guest goes to a neighbouring cell only if that is after
    the guest's own cell in the order of x, then y; pairs across cells so meet once at least.
    """

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            out = []
            for block, (part, budget) in enumerate(zip(rotation.parts(_matrix(batch.column(2))), rotation.budgets)):
                reach = float(np.sqrt(budget))
                width = 2 * reach
                flat = np.zeros((len(part), 2))
                flat[:, : min(2, part.shape[1])] = part[:, :2]
                low, own = np.floor((flat - reach) / width), np.floor(flat / width)
                high = np.floor((flat + reach) / width)
                for dx, dy in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1)):
                    to = own + (dx, dy)
                    use = np.flatnonzero(((to >= low) & (to <= high)).all(axis=1))
                    out.append((use, block, to[use].astype(np.int64), (dx, dy) == (0, 0), part[use]))
            rows = np.concatenate([u for u, *_ in out])
            count = [len(u) for u, *_ in out]
            parts = [p for *_, p in out]
            flat = np.concatenate([p.ravel() for p in parts])
            ends = np.cumsum(np.concatenate([np.full(len(p), p.shape[1]) for p in parts]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    batch.column(1).take(pa.array(rows)),
                    pa.array(np.repeat([b for _, b, *_ in out], count).astype(np.int32)),
                    pa.array(np.concatenate([t[:, 0] for _, _, t, *_ in out])),
                    pa.array(np.concatenate([t[:, 1] for _, _, t, *_ in out])),
                    pa.array(np.repeat([h for *_, h, _ in out], count)),
                    pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(flat)),
                ],
                ["class", "label", "block", "x", "y", "home", "part"],
            )

    schema = "class long, label string, block int, x long, y long, home boolean, part array<double>"
    return vectors.select("class", "label", "embedding").mapInArrow(cells, schema)


def _candidates(cells: DataFrame, rotation: _Rotation) -> DataFrame:
    """Pairs of classes ``a > b`` within a block's budget in at least one block."""
    cell = ["label", "block", "x", "y"]
    sizes = cells.filter("home").groupBy(*cell).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    guests = cells.filter("not home").groupBy(*cell).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("more"))
    known = cells.join(sizes, cell).join(guests, cell, "left")
    of = F.when(F.col("home"), F.col("chunks")).otherwise(F.col("more"))
    known = known.withColumn("chunk", F.pmod(F.xxhash64("class"), of.cast("long")))
    packed = known.groupBy(*cell, "home", "chunk").agg(
        F.collect_list("class").alias("classes"), F.flatten(F.collect_list("part")).alias("parts")
    )
    packed = written(packed)
    left = packed.filter("home")
    right = packed.select(*cell, *(F.col(c).alias(f"{c}_b") for c in ("home", "chunk", "classes", "parts")))
    # A chunk of the cell's own meets each guest chunk, and its own chunks from itself on.
    met = left.join(right, cell).filter("not home_b or chunk_b >= chunk")
    budgets = rotation.budgets

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for block, ca, pa_, cb, pb in zip(*(batch.column(i) for i in range(5))):
                ca, cb = ca.values.to_numpy(), cb.values.to_numpy()
                x = pa_.values.to_numpy().reshape(len(ca), -1)
                y = pb.values.to_numpy().reshape(len(cb), -1)
                square = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
                i, j = np.nonzero(square <= budgets[block.as_py()] + SLACK)
                first.append(ca[i])
                second.append(cb[j])
            a, b = np.concatenate(first), np.concatenate(second)
            lo, hi = np.minimum(a, b), np.maximum(a, b)
            use = lo != hi
            yield pa.RecordBatch.from_arrays([pa.array(hi[use]), pa.array(lo[use])], ["a", "b"])

    pairs = met.select("block", "classes", "parts", "classes_b", "parts_b").mapInArrow(near, "a long, b long")
    return pairs.distinct()


def _verified(pairs: DataFrame, vectors: DataFrame, cosine: float) -> DataFrame:
    """Pairs whose cosine in double precision reaches the threshold."""
    first = vectors.select(F.col("class").alias("a"), F.col("embedding").alias("va"))
    second = vectors.select(F.col("class").alias("b"), F.col("embedding").alias("vb"))
    both = pairs.join(first, "a").join(second, "b")

    @F.arrow_udf("double")
    def cos(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = _unit(_matrix(a)), _unit(_matrix(b))
        return pa.array((x * y).sum(axis=1))

    return written(both.select("a", "b", cos("va", "vb").alias("c")).filter(F.col("c") >= cosine).select("a", "b"))


def near_duplicates(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    blocks: int = BLOCKS,
) -> DataFrame:
    """``id, n_links, component_id, kept``: one row for each row of ``vectors``.

    Rows link when their labels are equal and not null, and their vectors, of equal length,
    have a cosine of ``cosine`` or more. Vectors that are null, empty, zero, or hold a null or
    non-finite component link with nothing, and so do rows with a null id, whose component is
    null and which are kept. Each row counts as a link of its own: rows that repeat an id too.
    """
    small_batches(vectors.sparkSession)
    plain = vectors.select(
        vectors[id].alias("id"),
        vectors[label].cast("string").alias("label"),
        vectors[vector].cast("array<double>").alias("embedding"),
    )
    usable = F.coalesce(
        F.col("id").isNotNull() & F.col("label").isNotNull() & _valid("embedding"), F.lit(False)
    )
    # 128 bits of hash stand for a vector's components.
    hashes = F.struct(F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"))
    key = F.when(usable, hashes)
    rows = written(plain.withColumn("key", key))
    groups = rows.filter("key is not null").groupBy("label", "key")
    classes = written(
        groups.agg(F.min("id").alias("id"), F.count("*").alias("size"), F.first("embedding").alias("embedding"))
        .withColumn("dim", F.size("embedding"))
        # A number for each class that no other has, whatever ids repeat; fixed once written.
        .withColumn("class", F.monotonically_increasing_id())
    )
    links = None
    for (dim,) in classes.select("dim").distinct().orderBy("dim").collect():
        same = classes.filter(F.col("dim") == dim)
        rotation = _Rotation(_moments(same.select("embedding"), dim), blocks, cosine)
        found = _verified(_candidates(_cells(same, rotation), rotation), same, cosine)
        links = found if links is None else links.union(found)
    ids = classes.select("class", "id", "size")
    if links is None:
        links = ids.select(F.col("class").alias("a"), F.col("class").alias("b")).limit(0)
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = both.join(ids.select(F.col("class").alias("b"), F.col("size").alias("other")), "b")
    counts = counts.groupBy(F.col("a").alias("class")).agg(F.sum("other").alias("others"))
    named = links.join(ids.select(F.col("class").alias("a"), F.col("id").alias("ia")), "a")
    named = named.join(ids.select(F.col("class").alias("b"), F.col("id").alias("ib")), "b")
    # Rows of one id are one node: their classes meet in it.
    twins = rows.filter("key is not null").join(
        classes.select("label", "key", F.col("id").alias("lowest")), ["label", "key"]
    )
    twins = twins.filter("id <> lowest").join(
        rows.filter("key is not null").groupBy("id").agg(F.count_distinct("label", "key").alias("k")).filter("k > 1"), "id"
    )
    edges = named.select(F.col("ia").alias("a"), F.col("ib").alias("b"))
    edges = edges.union(twins.select(F.col("id").alias("a"), F.col("lowest").alias("b")))
    components = written(connected(edges))
    result = (
        classes.select("label", "key", "class", "id", "size")
        .join(counts, "class", "left")
        .join(components.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "label",
            "key",
            (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    out = rows.select("id", "label", "key").join(result, ["label", "key"], "left").select(
        F.col("id").alias(id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col(id) == F.col("component_id"), F.lit(True)))


# The digest by comparing all pairs of a label.
SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
usable AS (
  SELECT vec_id, label, e FROM v
  WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(e, e) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id, vec_id AS other FROM v
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.other)
SELECT vec_id, (SELECT count(*) FROM link WHERE a = v.vec_id) AS n_links, c.component_id, c.component_id = vec_id AS kept
FROM v JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) c USING (vec_id)
"""
