"""Monitoring streams: rates, counters and redelivery removal.

Each epoch's rows go to an epoch log, where a replayed epoch replaces itself. Rates are
partial counts that add up; counters run in update mode, so their view takes the newest
row per key and generation, and adds generations up, because a new checkpoint starts
counting at zero again. Every ``fold_every`` epochs a log is folded by the aggregation that
reads it, so a reader opens a bounded number of epochs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eddyline.operators.deadletters import folded_failures, scheduled
from eddyline.operators.metrics import counter_families, rates_from_steps, step_counts
from eddyline.sinks.epoch_log import VERSION, fold, latest_rows, read_kept, read_log, write_epoch
from eddyline.streaming.pipeline import start


FOLD_EVERY = 16


def _to_log(path: str, generation: int, combine, fold_every: int, shape=lambda batch: batch):
    def write(batch: DataFrame, epoch: int) -> None:
        write_epoch(shape(batch), path, epoch, generation)
        if epoch % fold_every == fold_every - 1:
            fold(batch.sparkSession, path, combine)

    return write


def _tagged(rows: DataFrame, log: DataFrame) -> DataFrame:
    """A fold's rows as rows of the log. The version of added-up rows says nothing."""
    lost = [F.lit(-1).cast("bigint").alias(name) for name in VERSION if name not in rows.columns]
    return rows.select("*", *lost).select(*log.columns)


def start_rate_stream(
    events: DataFrame, time: str, by: list[str], path: str, checkpoint: str, generation: int = 0, fold_every: int = FOLD_EVERY, **options,
) -> StreamingQuery:
    """Counts per 10-second step of event time, partial ones of each epoch. They add up
    when read, so an event counts however late it comes and no state is kept."""
    combine = lambda log: _tagged(_step_sums(log, by), log)
    return start(events, _to_log(path, generation, combine, fold_every, lambda batch: step_counts(batch, time, by)), checkpoint, **options)


def _step_sums(log: DataFrame, by: list[str]) -> DataFrame:
    return log.groupBy(*by, "step").agg(F.sum("n").cast("bigint").alias("n"))


def read_rates(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    return rates_from_steps(_step_sums(read_kept(spark, path), by), by)


def start_counter_stream(
    op_log: DataFrame, labels: list[str], path: str, checkpoint: str, generation: int = 0, fold_every: int = FOLD_EVERY, **options
) -> StreamingQuery:
    """Running totals per label combination; the label sets bound the state."""
    totals = op_log.groupBy(*labels).agg(F.count("*").alias("n"))
    combine = lambda log: _tagged(_newest_counts(log, labels), log)
    return start(totals, _to_log(path, generation, combine, fold_every), checkpoint, mode="update", **options)


def _newest_counts(log: DataFrame, labels: list[str]) -> DataFrame:
    """Totals only grow, so the newest of a generation is the largest."""
    newest = F.max(F.struct("epoch_id", "n")).alias("newest")
    return log.groupBy(*labels, "generation").agg(newest).select(*labels, "generation", "newest.epoch_id", "newest.n")


def read_counters(spark: SparkSession, path: str, labels: list[str]) -> DataFrame:
    return counter_families(_newest_counts(read_kept(spark, path), labels).drop(*VERSION))


def start_failure_stream(
    failures: DataFrame, path: str, checkpoint: str, generation: int = 0, fold_every: int = FOLD_EVERY, **options
) -> StreamingQuery:
    """The retry state of a failure log as it grows: keys that failed again are written
    anew. One state row per failing key."""
    combine = lambda log: _tagged(latest_rows(log, ["key"], list(VERSION)), log)
    return start(folded_failures(failures), _to_log(path, generation, combine, fold_every), checkpoint, mode="update", **options)


def read_failures(spark: SparkSession, path: str, **schedule) -> DataFrame:
    """The newest state per key, with status and next retry. A new generation starts with
    an empty state, so it has to be fed the whole log again."""
    newest = latest_rows(read_kept(spark, path), ["key"], list(VERSION))
    return scheduled(newest.drop(*VERSION), **schedule)


def drop_redelivered(events: DataFrame, key: str, time: str, delay: str = "1 minute") -> DataFrame:
    """First arrival of each key; later ones within the watermark delay are dropped."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def start_dedupe_stream(
    events: DataFrame, key: str, time: str, path: str, checkpoint: str, ttl: str = "1 day", generation: int = 0, fold_every: int = 8, **options,
) -> StreamingQuery:
    """Each key once, with memory of the last ``ttl`` of event time.

    Before each epoch the clock stands at the latest event time of earlier epochs. A row
    older than that by more than ``ttl`` is late: whether its key came before is no longer
    known, so it is kept apart as a letter (``read_late``) and not dropped. Of the others the
    first row of each key stays unless the key is remembered (``read_unique``). Rows without a
    key are all different; rows without a time are never late, and their keys are kept for good. Every epoch enters its balance:
    rows in = out + repeats + late (``read_balance``).

    What is remembered are keys and times alone, folded every ``fold_every`` epochs to those
    within ``ttl``, so an epoch reads and keeps as much however long the stream runs.
    """
    keys, balance = f"{path}/keys", f"{path}/balance"

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        memory = read_kept(spark, keys, before=(generation, epoch))
        clock = None if memory is None else memory.agg(F.max(time)).first()[0]
        horizon = F.lit(None).cast("timestamp") if clock is None else F.lit(clock) - F.expr(f"INTERVAL {ttl}")
        late = F.coalesce(F.col(time) < horizon, F.lit(False))
        rows = Observation()
        tagged = batch.observe(rows, F.count("*").alias("n")).withColumn("late", late)
        # A late row and one without a key are groups of their own.
        single = F.when(F.col("late") | F.col(key).isNull(), F.monotonically_increasing_id())
        rest = [c for c in tagged.columns if c != key]
        once = tagged.withColumn("_single", single).groupBy(key, "_single").agg(F.min_by(F.struct(*rest), F.struct(F.col(time))).alias("row")).select(key, "row.*")
        if memory is not None:
            known = memory.filter(F.coalesce(F.col(time) >= horizon, F.lit(True))).select(F.col(key).alias("_known")).distinct()
            once = once.join(known, (F.col(key) == F.col("_known")) & ~F.col("late"), "left_anti")
        write_epoch(once.select(*batch.columns, F.col("late").cast("int").alias("late")), path, epoch, generation, by=("late",))
        written = read_log(spark, path, only=[(generation, epoch)])
        n_late, kept = written.agg(F.count_if(F.col("late") == 1), F.count_if(F.col("late") == 0)).first()
        line = [(rows.get["n"], kept, rows.get["n"] - n_late - kept, n_late)]
        write_epoch(spark.createDataFrame(line, "rows_in bigint, rows_out bigint, repeats bigint, late bigint"), balance, epoch, generation)
        mine = written.filter(F.col(key).isNotNull() & (F.col("late") == 0))
        write_epoch(mine.select(key, time), keys, epoch, generation)
        if epoch % fold_every == fold_every - 1:
            fold(spark, keys, lambda log: log.filter(F.coalesce(F.col(time) >= horizon, F.lit(True))))

    return start(events, write, checkpoint, **options)


def read_unique(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path).filter("late = 0").drop("late", *VERSION)


def read_late(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path).filter("late = 1").drop("late", *VERSION)


def read_balance(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path=f"{path}/balance")
