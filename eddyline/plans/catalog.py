"""Registry of the named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its equivalent on the same tables."""

    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def plain_time(name: str) -> Column:
    """A timestamp without zone, as the tables have it."""
    return F.col(name).cast("timestamp_ntz").alias(name)


def rounded(name: str, digits: int = 6) -> Column:
    return F.round(F.col(name), digits).alias(name)


def hash_vector_columns(vector: str = "vector") -> list[Column]:
    """A hash vector in comparable columns: its width, the 16 byte values it starts
    with, and whether all the rest repeats them."""
    v, head = F.col(vector), F.slice(vector, 1, 16)
    values = F.array_join(F.transform(head, lambda x: F.round(x * 255).cast("int").cast("string")), ",")
    repeated = F.slice(F.flatten(F.array_repeat(head, 24)), 1, 384)
    return [F.size(v).alias("width"), values.alias("cells"), (v == repeated).alias("repeats")]
