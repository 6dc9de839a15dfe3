"""The points table: upsert by id without a table format.

Writes go to an epoch log; reads take the newest row per id (merge on read).
``compact`` folds everything up to an epoch into a new base folder and records it in
a manifest, after which a read shuffles only the epochs that came later.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eddyline.functions.text import stable_id
from eddyline.functions.vectors import has_width
from eddyline.schemas import VECTOR_WIDTH
from eddyline.session import tasks_for
from eddyline.sinks.epoch_log import VERSION, drop_epochs, epochs, read_log, write_epoch

#: Beaten rows, as file names and row numbers or as ids, that a read broadcasts (some 10 MB).
FEW_BEATEN = 100_000
MANIFEST_SCHEMA = "generation bigint, epoch_id bigint, base string"


def with_point_ids(points: DataFrame) -> DataFrame:
    """A missing id becomes the hash of the payload, so a replay finds the same id."""
    return points.withColumn("id", stable_id(F.col("id"), F.col("payload")))


def with_payload(points: DataFrame) -> DataFrame:
    """Payload, else the metadata, else an empty map (both map columns)."""
    empty = F.create_map().cast("map<string,string>")
    sources = [F.col(c) for c in ("payload", "metadata") if c in points.columns]
    return points.withColumn("payload", F.coalesce(*sources, empty)).drop("metadata")


def split_by_width(points: DataFrame, width: int = VECTOR_WIDTH) -> tuple[DataFrame, DataFrame]:
    """(points that fit the collection, the others). NULL vectors do not fit."""
    fits = has_width(F.col("vector"), width)
    return points.filter(fits), points.filter(~fits)


def upsert_points(points: DataFrame, path: str, epoch_id: int, generation: int = 0) -> None:
    """Write one epoch. ``offset`` orders rows of one id inside the epoch."""
    write_epoch(points, path, epoch_id, generation)


def _newest_base(spark: SparkSession, path: str):
    manifest = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    if not manifest.getFileSystem(spark._jsc.hadoopConfiguration()).exists(manifest):
        return None
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/manifest")
    return rows.orderBy(F.desc("generation"), F.desc("epoch_id")).first()


def _newest_points(spark: SparkSession, path: str, only: list[tuple[int, int]]) -> DataFrame:
    """The newest row of each id. Who wins is settled on ids and versions alone; the rows of
    the others are then left out by file and place, and vectors and payloads are read once
    and never sorted: beaten rows are sent to them while they are few, else both are dealt to
    tasks of a fixed number of rows."""
    log = read_log(spark, path, only=only, place=True)
    place = ["_file", "_row"]
    order = [F.col(c).desc_nulls_last() for c in ("generation", "epoch_id", "offset")] + [F.col(c) for c in place]
    keys = log.select("id", *VERSION, "offset", *place)
    tasks = tasks_for(keys.count(), spark)
    ranked = keys.repartition(tasks, "id").withColumn("_rank", F.row_number().over(Window.partitionBy("id").orderBy(*order)))
    return _without(log, ranked.filter("_rank > 1").select(*place), place).drop(*place)


def _without(rows: DataFrame, beaten: DataFrame, keys: list[str]) -> DataFrame:
    if beaten.count() <= FEW_BEATEN:
        return rows.join(F.broadcast(beaten), keys, "left_anti")
    tasks = tasks_for(rows.count(), rows.sparkSession)
    return rows.repartition(tasks, *keys).join(beaten.repartition(tasks, *keys).hint("shuffle_hash"), keys, "left_anti")


def _table(spark: SparkSession, path: str, upto: tuple[int, int] | None = None) -> DataFrame:
    base = _newest_base(spark, path)
    folded = (base.generation, base.epoch_id) if base else (-1, -1)
    later = [e for e in epochs(spark, path) if e > folded and (upto is None or e <= upto)]
    if base is None:
        return _newest_points(spark, path, later)
    kept = spark.read.parquet(base.base)
    if not later:
        return kept
    delta = _newest_points(spark, path, later)
    # The ids alone are read for the anti join.
    unchanged = _without(kept, read_log(spark, path, only=later).select("id").distinct(), ["id"])
    return unchanged.unionByName(delta)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return _table(spark, path)


def _scans(spark: SparkSession, path: str, base, done: list[tuple[int, int]]) -> list[DataFrame]:
    """What a fold of the epochs ``done`` reads."""
    later = [e for e in done if base is None or e > (base.generation, base.epoch_id)]
    return [read_log(spark, path, only=later), *([spark.read.parquet(base.base)] if base else [])]


def _dealt(table: DataFrame, scans: list[DataFrame]) -> DataFrame:
    """Vectors cost far more to write than to read: where files are so dense that their splits
    hold more rows than a task should write, rows are dealt by id, which each row has alone."""
    tasks = tasks_for(sum(s.count() for s in scans), table.sparkSession)
    return table.repartition(tasks, "id") if sum(s.rdd.getNumPartitions() for s in scans) < tasks else table


def compact(spark: SparkSession, path: str, retire: bool = False, keep: int = 1) -> None:
    """Fold all epochs but the newest ``keep`` into a new base. Readers switch when the
    manifest row appears.

    The newest epoch stays out: a stream that starts again may replay it, and the replay
    must win. ``keep=0`` folds that one too, for a writer that has finished it and will not
    write it again: a replay would not be read. With ``retire`` the folded epochs are
    deleted; no reader that began before may still be running then.
    """
    found = epochs(spark, path)
    done = found[: max(len(found) - keep, 0)]
    base = _newest_base(spark, path)
    if not done or base and done[-1] <= (base.generation, base.epoch_id):
        return
    folder = f"{path}/base/{uuid.uuid4().hex}"
    _dealt(_table(spark, path, upto=done[-1]), _scans(spark, path, base, done)).write.parquet(folder)
    row = [(*done[-1], folder)]
    spark.createDataFrame(row, MANIFEST_SCHEMA).write.mode("append").parquet(f"{path}/manifest")
    if retire:
        for generation in {g for g, _ in done}:
            drop_epochs(spark, path, 1 + max(e for g, e in done if g == generation), generation)
