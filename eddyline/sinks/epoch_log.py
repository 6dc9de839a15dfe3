"""Append-only tables written one streaming epoch at a time.

Layout: ``<path>/log/generation=<g>/epoch_id=<n>``. Writing an epoch overwrites its
own folder only, so a replayed micro-batch replaces itself instead of adding rows
twice. ``generation`` goes up when a query restarts from a new checkpoint, whose
epoch numbers begin at 0 again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = ("generation", "epoch_id")


def write_epoch(df: DataFrame, path: str, epoch_id: int, generation: int = 0, by: tuple[str, ...] = ()) -> None:
    """``by`` columns become folders below the epoch's."""
    folder = f"{path}/log/generation={int(generation)}/epoch_id={int(epoch_id)}"
    df.write.mode("overwrite").partitionBy(*by).parquet(folder)


def has_epochs(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/log")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def drop_epochs(spark: SparkSession, path: str, before: int, generation: int = 0) -> int:
    """Retention: deletes the epochs of a generation below ``before``; returns how many."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/log/generation={int(generation)}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return 0
    gone = 0
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("epoch_id=") and int(name.split("=")[1]) < before:
            gone += bool(files.delete(status.getPath(), True))
    return gone


def epochs(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(generation, epoch) of every epoch folder. Names only are listed, no files."""
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/log")
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(top):
        return []
    number = lambda status, key: int(status.getPath().getName().removeprefix(f"{key}="))
    found = []
    for generation in files.listStatus(top):
        if generation.getPath().getName().startswith("generation="):
            inner = files.listStatus(generation.getPath())
            found += [(number(generation, "generation"), number(e, "epoch_id")) for e in inner if e.getPath().getName().startswith("epoch_id=")]
    return sorted(found)


def read_log(
    spark: SparkSession, path: str, schema: T.StructType | None = None, only: list[tuple[int, int]] | None = None, place: bool = False
) -> DataFrame:
    """Every row of every epoch, or of ``only`` some, tagged with its generation and epoch.
    The folders of other epochs are not looked into. With ``place`` each row has the name of
    its file and its number there, ``_file`` and ``_row``."""
    reader = spark.read
    if schema is not None:
        tagged = T.StructType(list(schema.fields))
        for name in VERSION:
            tagged = tagged.add(name, T.LongType())
        reader = reader.schema(tagged)
    if only is None:
        log = reader.parquet(f"{path}/log")
    else:
        folders = [f"{path}/log/generation={g}/epoch_id={e}" for g, e in only]
        log = reader.option("basePath", f"{path}/log").parquet(*folders)
    if place:
        log = log.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    for name in VERSION:
        log = log.withColumn(name, F.col(name).cast("bigint"))
    return log


def _newest_fold(spark: SparkSession, path: str) -> tuple[tuple[int, int], str | None]:
    """The last epoch that is folded, and the finished folder that holds the fold."""
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/folded")
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    newest = ((-1, -1), None)
    if files.exists(top):
        for status in files.listStatus(top):
            name = status.getPath().getName()
            if files.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                newest = max(newest, (tuple(map(int, name.split("-"))), f"{path}/folded/{name}"))
    return newest


def read_kept(spark: SparkSession, path: str, before: tuple[int, int] | None = None) -> DataFrame | None:
    """The newest fold and the epochs after it, up to ``before``; None where there are none.

    ``before`` must be an epoch that is not folded yet, which the newest one never is.
    """
    upto, folder = _newest_fold(spark, path)
    later = [e for e in epochs(spark, path) if e > upto and (before is None or e < before)]
    parts = [spark.read.parquet(folder)] if folder else []
    if later:
        parts.append(read_log(spark, path, only=later))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def fold(spark: SparkSession, path: str, combine, keep: int = 1) -> int:
    """Replaces all epochs but the newest ``keep`` by ``combine(rows)``; returns how many.

    ``combine`` gives rows of the log's own columns, generation and epoch included, which
    mean the same to a reader. A fold becomes visible when it is finished; what it holds is
    deleted after that, so no reader may have begun before. The newest epoch stays out, as
    a restarted query may write it again.
    """
    upto, old = _newest_fold(spark, path)
    found = [e for e in epochs(spark, path) if e > upto]
    done = found[: len(found) - max(keep, 1)]
    if not done:
        return 0
    rows = read_log(spark, path, only=done)
    if old:
        rows = spark.read.parquet(old).unionByName(rows, allowMissingColumns=True)
    combine(rows).write.mode("overwrite").parquet(f"{path}/folded/{done[-1][0]}-{done[-1][1]}")
    for generation in {g for g, _ in done}:
        drop_epochs(spark, path, 1 + max(e for g, e in done if g == generation), generation)
    if old:
        gone = spark._jvm.org.apache.hadoop.fs.Path(old)
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return len(done)


def latest_rows(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the one with the highest ``order``.

    The limit of one row per key is applied in each task before the shuffle, so a key
    written many times moves once per task. Rows are neither packed nor compared whole.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    ranked = log.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1")
    return ranked.select(*keys, *[c for c in log.columns if c not in keys])
