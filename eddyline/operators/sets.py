"""Set operations over batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_batches(batches: list[DataFrame]) -> DataFrame:
    """All rows of all batches, matched by column name; missing columns become NULL."""
    if not batches:
        raise ValueError("no batches to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def union_letters(failed: DataFrame, retry: DataFrame) -> DataFrame:
    """Failed and waiting dead letters together, duplicates kept."""
    return failed.unionByName(retry)
