"""Batch documents: JSON scans and the files still to be read."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: one alternation covers the three input patterns without overlap.
INPUT_GLOB = "*.{json,jsonl}"


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    multi_line: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """JSON documents. With a schema the inference pass over the data is skipped.

    JSON lines split across tasks; ``multi_line`` files (one JSON value over many
    lines) do not, so it is an explicit choice and never derived from file size.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.json(path)


CORRUPT = "_corrupt"


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema with a column that keeps a line that is no JSON of that shape."""
    return T.StructType([*(f for f in schema.fields if f.name != CORRUPT), T.StructField(CORRUPT, T.StringType())])


def stream_documents(
    spark: SparkSession, path: str, schema: T.StructType, glob: str = INPUT_GLOB, archive: str | None = None, **options
) -> DataFrame:
    """New files as they arrive; the query's checkpoint remembers the finished ones. Lines
    that cannot be decoded are kept in ``_corrupt``. A packed file that breaks off gives the
    rows before that, so whoever takes the rows has to ask ``unreadable_files``.

    With ``archive``, a folder outside ``path``, the files of an epoch are moved there, under
    their whole path, once the epoch is done: at the latest when the query runs again.
    """
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    return (
        spark.readStream.schema(with_corrupt(schema))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("ignoreCorruptFiles", True)
        .option("pathGlobFilter", glob)
        .options(**options)
        .json(path)
    )


PACKED = (".gz", ".deflate", ".bz2")


def unreadable_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file, error`` of those of the given files whose compressed content does not unpack:
    cut short, or no such content at all. One file at a time passes through a task. Paths are
    as ``_metadata.file_path`` has them."""
    packed = [unquote(p) for p in paths if p.endswith(PACKED)]
    if not packed:
        return spark.createDataFrame([], "file string, error string")
    files = spark.read.format("binaryFile").load(packed).select(F.col("_metadata.file_path").alias("file"), "content")
    return files.mapInArrow(_unpack_errors, "file string, error string")


def _unpack_errors(batches):
    import bz2
    import zlib

    import pyarrow as pa

    openers = {".gz": lambda: zlib.decompressobj(47), ".deflate": lambda: zlib.decompressobj(47), ".bz2": bz2.BZ2Decompressor}
    for batch in batches:
        found = []
        for file, content in zip(batch.column("file").to_pylist(), batch.column("content")):
            opener = next((o for end, o in openers.items() if file.endswith(end)), None)
            rest = memoryview(content.as_buffer()) if opener and content.is_valid else memoryview(b"")
            try:
                while len(rest):
                    unpacked, size = opener(), 1 << 20
                    for start in range(0, len(rest), size):
                        unpacked.decompress(rest[start : start + size])
                        if unpacked.eof:
                            break
                    if not unpacked.eof:
                        raise EOFError("ends too early")
                    # Several packed parts may follow each other in one file.
                    rest = rest[min(start + size, len(rest)) - len(unpacked.unused_data) :]
            except (EOFError, OSError, ValueError, zlib.error) as error:
                found.append((file, f"{type(error).__name__}: {error}"))
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in found], pa.string()), pa.array([e for _, e in found], pa.string())], names=["file", "error"])


def list_files(spark: SparkSession, folder: str, glob: str = INPUT_GLOB) -> DataFrame:
    """Path, size and time of each file. Contents are pruned from the scan.

    The path is written as the document streams write it (``_metadata.file_path``), so
    names with spaces, percent signs or other letters mean the same file in both.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(F.col("_metadata.file_path").alias("path"), "length", F.col("modificationTime").alias("modified_at"))
    )


def pending_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files without a successful ledger entry, small ones first.

    The key is the full path, so ``a.json`` and ``a.jsonl`` stay apart.
    """
    done = ledger.filter(F.col("status") == "success").select(F.col("file").alias("path"))
    return files.join(done, "path", "left_anti").orderBy("length", "path")
