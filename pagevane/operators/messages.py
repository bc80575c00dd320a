"""JSON messages between stages: decode, check, encode, set bad ones aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The stage messages.
MANIFEST_SCHEMA = T.StructType([T.StructField("warc_url", T.StringType())])
TEXT_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("h1", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
INDEX_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("h1", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

ERROR = "_error"
CORRUPT = "_corrupt"


def decode_messages(
    df: DataFrame,
    schema: T.StructType,
    required: tuple[str, ...] | None = None,
    value: str = "value",
) -> DataFrame:
    """Parse the JSON column ``value`` into the fields of ``schema``.

    Nothing is thrown away: ``_error`` is null for a good message, otherwise it
    says why the message cannot be used (``corrupt`` JSON, or the first missing
    required field). Other columns are kept, and so is ``value``.
    """
    parsed = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    record = F.from_json(F.col(value), parsed, options)
    with_record = df.select("*", F.inline(F.array(F.struct(record.alias("_record")))))
    fields = with_record.select("*", "_record.*").drop("_record")
    required = schema.fieldNames() if required is None else required
    is_blank = F.col(value).isNull() | (F.trim(value) == "")
    is_corrupt = F.col(CORRUPT).isNotNull() | is_blank
    return require_fields(fields, *required, first_error=is_corrupt).drop(CORRUPT)


def require_fields(df: DataFrame, *required: str, first_error: Column | None = None) -> DataFrame:
    """Add ``_error``: null if all required fields are present."""
    error = F.when(first_error, F.lit("corrupt")) if first_error is not None else None
    for name in required:
        missing, reason = F.col(name).isNull(), F.lit(f"missing {name}")
        error = F.when(missing, reason) if error is None else error.when(missing, reason)
    return df.withColumn(ERROR, error if error is not None else F.lit(None).cast("string"))


def encode_messages(df: DataFrame, *fields: str) -> DataFrame:
    """One JSON string per row in ``value``, from the named fields (all if none)."""
    return df.select(F.to_json(F.struct(*(fields or df.columns))).alias("value"))
