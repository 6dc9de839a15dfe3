"""Dead letters: the failure log, the retry state folded from it, replay and statistics.

A failure log row has ``key, topic, partition, offset, value, failure_reason,
error_message, failed_at``. The state has one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.schemas import DLQ_STATE, FAILURE_REASONS, JSON_TIME, MAX_RETRIES, RETRY_DELAYS_SECONDS


def message_key() -> Column:
    """The message id, else its Kafka coordinates. Makes one equi-join key of the two."""
    return F.coalesce(F.col("id"), F.concat_ws("|", "topic", "partition", "offset"))


def known_reason(reason: Column) -> Column:
    return F.when(reason.isin(*FAILURE_REASONS), reason).otherwise(F.lit("unknown_error"))


def dead_letter_rows(
    records: DataFrame,
    reason: Column,
    error: Column,
    failed_at: Column,
    key: str = "key",
    value: str = "value",
    retry_count: Column | None = None,
    headers: Column | None = None,
) -> DataFrame:
    """Failed records in the log shape."""
    no_headers = F.lit(None).cast("map<string,string>")
    return records.select(
        F.col("topic").alias("original_topic"),
        F.col("partition").cast("int").alias("original_partition"),
        F.col("offset").cast("bigint").alias("original_offset"),
        F.col(key).cast("string").alias("original_key"),
        F.col(value).cast("string").alias("original_value"),
        known_reason(reason).alias("failure_reason"),
        error.alias("error_message"),
        failed_at.alias("failed_at"),
        (F.lit(0) if retry_count is None else retry_count).cast("int").alias("retry_count"),
        (no_headers if headers is None else headers).alias("original_headers"),
    )


def _retry_after(delays) -> Column:
    """Last failure, cut to the second, plus the delay of this attempt."""
    step = F.least(F.col("attempt_count"), F.lit(len(delays))).cast("int")
    seconds = F.element_at(F.array(*[F.lit(d) for d in delays]), step)
    return F.date_trunc("second", "last_failure_time") + F.make_dt_interval(secs=seconds)


def scheduled(folded: DataFrame, max_retries: int = MAX_RETRIES, delays=RETRY_DELAYS_SECONDS) -> DataFrame:
    """Adds status and the time of the next retry to folded failures."""
    exhausted = F.col("attempt_count") >= max_retries
    return folded.withColumn(
        "status", F.when(exhausted, F.lit("failed")).otherwise(F.lit("retry"))
    ).withColumn("retry_after", F.when(~exhausted, _retry_after(delays)))


def fold_failures(
    failures: DataFrame, max_retries: int = MAX_RETRIES, delays=RETRY_DELAYS_SECONDS
) -> DataFrame:
    """One state row per key from its failures.

    The reason stays that of the first failure, the error text is that of the last.
    Only counts, extremes and their companions are kept, so partial aggregation shrinks
    a key with very many failures to one row per task before the shuffle.
    """
    return scheduled(folded_failures(failures), max_retries, delays)


def folded_failures(failures: DataFrame) -> DataFrame:
    """The fold alone, which a stream can keep up to date row by row (update mode)."""
    when = F.struct("failed_at", "offset")
    return failures.groupBy("key").agg(
        F.count("*").alias("attempt_count"),
        F.min("failed_at").alias("first_failure_time"),
        F.max("failed_at").alias("last_failure_time"),
        F.min_by(F.struct("failure_reason", "topic", "partition", "offset", "value"), when).alias("first"),
        F.max_by("error_message", when).alias("error_details"),
    ).select(
        "key",
        F.col("first.failure_reason").alias("failure_reason"), "error_details",
        "attempt_count", "first_failure_time", "last_failure_time",
        "first.topic", "first.partition", "first.offset",
        F.col("first.value").alias("original_message"),
    )


def write_state(state: DataFrame, path: str) -> None:
    """The state as JSON lines, one row each, in the saved shape (``DLQ_STATE``)."""
    saved = state.withColumnRenamed("key", "id").select(*DLQ_STATE.names)
    saved.write.mode("overwrite").option("timestampFormat", JSON_TIME).json(path)


def read_state(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """(state, lines that do not parse) of a saved state."""
    rows, bad = split_corrupt_state(spark.read.text(path), DLQ_STATE)
    return rows.withColumnRenamed("id", "key"), bad


def due_retries(state: DataFrame, now: Column, page: int | None = None) -> DataFrame:
    """All retries whose time has come, longest-failing first; with ``page`` the first
    so many of them."""
    due = (F.col("status") == "retry") & (F.col("retry_after") <= now)
    ordered = state.filter(due).orderBy("first_failure_time", "key")
    return ordered if page is None else ordered.limit(page)


def fold_with_outcomes(failures: DataFrame, outcomes: DataFrame, **schedule) -> DataFrame:
    """State after retries were carried out.

    ``outcomes`` rows are ``key, finished_at, succeeded, raised`` with the failure-log columns. A
    failed retry is one more failure (``processing_error`` when the callback raised); a
    success removes the key, and only failures after it count from then on.
    """
    retried = outcomes.filter(~F.col("succeeded")).select(
        "key", "topic", "partition", "offset", "value",
        F.when(F.col("raised"), F.lit("processing_error"))
        .otherwise(F.col("failure_reason")).alias("failure_reason"),
        F.coalesce("error_message", F.lit("Retry failed")).alias("error_message"),
        F.col("finished_at").alias("failed_at"),
    )
    resets = outcomes.filter("succeeded").groupBy("key").agg(F.max("finished_at").alias("reset_at"))
    log = failures.select(*retried.columns).unionByName(retried)
    # A plain join: its right side has a row per key, and adaptive execution splits a key
    # that fails very often.
    live = log.join(resets, "key", "left").filter(
        F.col("reset_at").isNull() | (F.col("failed_at") > F.col("reset_at"))
    )
    return fold_failures(live.drop("reset_at"), **schedule)


def filter_letters(
    letters: DataFrame, key: str | None = None, reason: str | None = None, status: str | None = None
) -> DataFrame:
    """All given conditions must hold. A reason nobody knows is an error, not a no-op."""
    if reason is not None and reason not in FAILURE_REASONS:
        raise ValueError(f"unknown failure reason: {reason}")
    for column, wanted in (("key", key), ("failure_reason", reason), ("status", status)):
        if wanted is not None:
            letters = letters.filter(F.col(column) == wanted)
    return letters


def replay_records(
    letters: DataFrame, replayed_at: Column, target_topic: str | None = None
) -> DataFrame:
    """Dead letters (log shape) as (topic, key, value, headers) to produce again.

    A letter replayed before has its old replay headers replaced.
    """
    stamp = F.date_format(replayed_at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    added = F.create_map(
        F.lit("dlq_replay"), F.lit("true"),
        F.lit("dlq_replay_at"), stamp,
        F.lit("original_failure_reason"), F.col("failure_reason"),
    )
    names = ("dlq_replay", "dlq_replay_at", "original_failure_reason")
    old = F.map_filter("original_headers", lambda name, _: ~name.isin(*names))
    headers = F.when(F.col("original_headers").isNull(), added).otherwise(F.map_concat(old, added))
    topic = F.col("original_topic") if target_topic is None else F.lit(target_topic)
    return letters.select(
        topic.alias("topic"), F.col("original_key").alias("key"),
        F.col("original_value").alias("value"), headers.alias("headers"),
    )


def replayable(
    state: DataFrame, reason: str | None = None, max_retry_count: int | None = None
) -> DataFrame:
    """State rows a batch replay takes."""
    chosen = filter_letters(state, reason=reason)
    if max_retry_count is not None:
        chosen = chosen.filter(F.col("attempt_count") <= max_retry_count)
    return chosen


def without_replayed(state: DataFrame, replayed: DataFrame) -> DataFrame:
    """The state once the replayed keys have left it. Keys are unique on both sides."""
    return state.join(replayed.select("key"), "key", "left_anti")


def letter_page(
    state: DataFrame, limit: int = 10, after: tuple | None = None
) -> DataFrame:
    """One page in (first_failure_time, key) order with the total and a has_more flag.

    Pages are reached by the last row of the page before, not by skipping rows.
    """
    position = F.struct("first_failure_time", "key")
    follows = F.lit(True)
    if after is not None:
        time, key = after
        follows = position > F.struct(
            F.lit(time).cast("timestamp").alias("first_failure_time"), F.lit(key).alias("key")
        )
    counts = state.agg(
        F.struct(F.count("*").alias("all"), F.count_if(follows).alias("left"))
    ).scalar()
    return (
        state.filter(follows).orderBy("first_failure_time", "key").limit(limit)
        .withColumn("_counts", counts)
        .withColumn("total_count", F.col("_counts.all"))
        .withColumn("has_more", F.col("_counts.left") > limit)
        .drop("_counts")
    )


def letter_stats(state: DataFrame, now: Column) -> DataFrame:
    retry = F.col("status") == "retry"
    return state.agg(
        F.count_if(F.col("status") == "failed").alias("total_failed"),
        F.count_if(retry).alias("in_retry_queue"),
        F.count_if(retry & (F.col("retry_after") <= now)).alias("ready_for_retry"),
    )


def letters_by_reason(state: DataFrame) -> DataFrame:
    return state.groupBy("failure_reason").agg(F.count("*").alias("n"))


def queue_depth(letters: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages not yet read per partition, and the total in a NULL-partition row.

    Both sides shrink to one row per partition before they meet.
    """
    high = letters.groupBy("partition").agg((F.max("offset") + 1).alias("high_water"))
    depth = high.join(committed, "partition", "left").select(
        "partition", "high_water",
        F.coalesce("position", F.lit(0)).cast("bigint").alias("position"),
    )
    return depth.rollup("partition").agg(
        F.sum("high_water").alias("high_water"),
        F.sum("position").alias("position"),
        F.sum(F.col("high_water") - F.col("position")).alias("lag"),
    )


def split_corrupt_state(lines: DataFrame, schema) -> tuple[DataFrame, DataFrame]:
    """JSON lines of saved state: (rows, lines that do not parse). A bad line stops nothing."""
    fields = [f for f in schema.fields if f.name != "_corrupt"]
    tagged = T.StructType([*fields, T.StructField("_corrupt", T.StringType())])
    parsed = lines.select(
        F.col("value").alias("line"),
        F.from_json("value", tagged, {"columnNameOfCorruptRecord": "_corrupt", "timestampFormat": JSON_TIME}).alias("row"),
    )
    bad = F.col("row").isNull() | F.col("row._corrupt").isNotNull()
    return parsed.filter(~bad).select("row.*").drop("_corrupt"), parsed.filter(bad).select("line")
