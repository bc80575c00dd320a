"""The index table: Parquet, append-only, one folder per load."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagevane.functions.vectors import DIM
from pagevane.operators.embed import dim_check
from pagevane.operators.index import index_rows
from pagevane.operators.messages import ERROR, require_fields
from pagevane.sinks.postings import append_postings, postings_path
from pagevane.sinks.seen import keyed, remember, seen_path, unseen

CREATED = "created"
MESSAGE = ("url", "h1", "embedding")


def index_schema(dim: int = DIM) -> T.StructType:
    """The mapping: keyword, text and vector field; the dimension is field metadata."""
    vector = T.ArrayType(T.FloatType())
    return T.StructType(
        [
            T.StructField("url", T.StringType(), True, {"kind": "keyword"}),
            T.StructField("h1", T.StringType(), True, {"kind": "text"}),
            T.StructField("embedding", vector, True, {"kind": "knn_vector", "dim": dim}),
        ]
    )


def _load_path(path: str, load: str | int) -> str:
    return f"{path.rstrip('/')}/load={load}"


def index_exists(spark: SparkSession, path: str) -> bool:
    try:
        index_dim(spark, path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def create_index(spark: SparkSession, path: str, dim: int = DIM) -> bool:
    """Create an empty index unless there is one; returns whether it was created."""
    if index_exists(spark, path):
        return False
    empty = spark.createDataFrame([], index_schema(dim))
    empty.write.mode("overwrite").parquet(_load_path(path, CREATED))
    return True


def index_dim(spark: SparkSession, path: str) -> int:
    created = spark.read.parquet(_load_path(path, CREATED))
    return created.schema["embedding"].metadata["dim"]


def append_index(df: DataFrame, path: str, load: str | int, once: bool = False) -> int:
    """Add one load of good rows; returns their number. Writing the same load again replaces it.

    With ``once`` a message that another load has, or that is repeated in this one, isn't added; equal in all
    three fields are the same message. Loads that are written so are remembered, others aren't.

    The name of a load must be its own: a run's or a stream's id and its batch. Rows with
    ``_error`` or without a field the index needs, or whose vector doesn't have the index's
    dimension or holds a null, go to ``rejected_path`` with the reason,
    ``rebalance`` lets Spark even out the files by size, which also splits a hot
    url; a Bloom filter on the keyword field serves exact lookups, and the postings of the
    headings, written beside the table from the stored rows, full text.
    """
    known = index_exists(df.sparkSession, path)
    checked = _checked(df, index_dim(df.sparkSession, path) if known else None)
    good, bad = f"{path.rstrip('/')}/load={load}", f"{rejected_path(path)}/load={load}"
    rows = checked.filter(F.col(ERROR).isNull())
    if once:
        rows = unseen(rows, seen_path(path), load, *MESSAGE)
    (
        index_rows(rows).hint("rebalance").sortWithinPartitions("url")
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#url", "true")
        .parquet(good)
    )
    checked.filter(F.col(ERROR).isNotNull()).write.mode("overwrite").parquet(bad)
    stored = df.sparkSession.read.parquet(good)
    append_postings(stored, postings_path(path), load)
    if once:
        # After the rows: a load that was lost between the two is run again, and meets its own keys only.
        remember(keyed(stored, *MESSAGE), seen_path(path), load)
    # Row counts come from the file footers.
    return stored.count()


def rejected_path(path: str) -> str:
    """Where an index's bad messages go, beside it."""
    return f"{path.rstrip('/')}_rejected"


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Messages that were not indexed, of all loads: the three fields and ``_error``."""
    schema = index_schema().add(ERROR, T.StringType()).add("load", T.StringType())
    return spark.read.schema(schema).parquet(rejected_path(path))


def _checked(df: DataFrame, dim: int | None) -> DataFrame:
    known = [F.col(ERROR)] if ERROR in df.columns else []
    rows = df.select("url", "h1", F.col("embedding").cast("array<float>").alias("embedding"), *known)
    earlier = rows.withColumnRenamed(ERROR, "_earlier") if known else rows.withColumn("_earlier", F.lit(None))
    required = require_fields(earlier, "url", "h1", "embedding")
    checked = required.withColumn("dim_ok", F.lit(True)) if dim is None else dim_check(required, dim)
    reason = (
        F.when(F.col("_earlier").isNotNull(), F.col("_earlier"))
        .when(F.col(ERROR).isNotNull(), F.col(ERROR))
        .when(~F.col("dim_ok"), "wrong dimension")
        .when(F.exists("embedding", lambda x: x.isNull()), "null in vector")
    )
    return checked.withColumn(ERROR, reason.cast("string")).drop("_earlier", "dim_ok")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """All loads; ``load`` is a partition column."""
    schema = index_schema().add("load", T.StringType())
    return spark.read.schema(schema).parquet(path)
