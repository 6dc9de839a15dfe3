"""Vectors from a pluggable text encoder, in Arrow batches on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.functions.encoders import encode_body


def encode_texts(df: DataFrame, text: str, factory, width: int = 384, batch_size: int = 1000) -> DataFrame:
    """Adds ``vector`` and ``encode_error``. Rows stay in place: no grouping, no shuffle.

    ``factory()`` gives a function from a list of texts to a (texts x width) array; it runs
    once per task, so a model is loaded where it is used.
    """
    schema = f"{df.schema.toDDL()}, vector array<float>, encode_error string"
    return df.mapInArrow(encode_body(df.columns.index(text), factory, width, batch_size), schema)


def split_encode_errors(encoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a vector, rows for the dead letters as ``embedding_error``)."""
    failed = F.col("encode_error").isNotNull()
    good = encoded.filter(~failed).drop("encode_error")
    return good, encoded.filter(failed).drop("vector").withColumn("failure_reason", F.lit("embedding_error"))
