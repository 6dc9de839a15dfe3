"""What the operators of this subpackage share."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.session import fresh_folder, ship_package

# The ASCII white space that separates words and is stripped from lines.
ASCII_SPACE = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


ARROW_BATCH = "2m"
READ_ROWS = "64"


def prepare(spark: SparkSession) -> None:
    """What every query here needs of a session: the package on the executors, and Arrow and
    Parquet batches small enough that rows held at once, in the JVM and in Python, stay few:
    rows are whole texts, or bytes of many texts."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return table.select(*columns) if columns else table


def whole_text(column: str = "text") -> Column:
    """The text; NULL counts as empty everywhere in this subpackage."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` computed once, as a table in the shared folder: no lineage is left to
    repeat when an executor is lost, and no text is read twice. Large rows count at once
    towards a page, not after a hundred: pages are buffers outside the heap that stay."""
    path = fresh_folder(df.sparkSession, purpose)
    df.write.option("parquet.page.size.row.check.min", "1").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder_of_id(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a NULL id counts as ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def by_size(sizes, limit: int):
    """(start, stop) runs of consecutive rows whose sizes add up to about ``limit``."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def slices(batch: pa.RecordBatch, name: str, limit: int):
    """The batch in runs of rows whose cells of ``name`` (texts or lists) add up to about
    ``limit`` bytes or items, so that only one run at a time becomes Python objects."""
    column = batch.column(name)
    measure = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    for a, b in by_size(pc.fill_null(measure(column), 0).to_pylist(), limit):
        yield batch.slice(a, b - a)


def give_back() -> None:
    """Memory that Python and Arrow hold but do not use goes back to the system. A worker
    process outlives its tasks, and others of the executor need the memory."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    return [t or "" for t in batch.column(name).to_pylist()]
