"""The retry loop as a stream: failures and outcomes of retries in, due retries out.

One state per key with a timer. A failure schedules the next retry, a success clears the
key, and the retry comes out when its time has come, whether or not anything else arrives.
"""

from __future__ import annotations

import datetime
import json
import pickle
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from eddyline.schemas import MAX_RETRIES, RETRY_DELAYS_SECONDS
from eddyline.sinks.epoch_log import VERSION, fold, latest_rows, read_kept, write_epoch
from eddyline.streaming.pipeline import start

EVENT = "key string, success boolean, at_us bigint, topic string, partition int, offset bigint, value string, failure_reason string, error_message string"
DETAILS = ("topic", "partition", "offset", "value", "failure_reason", "error_message")
STEP = (
    "key string, seq bigint, status string, attempt_count bigint, first_us bigint, last_us bigint, failure_reason string, "
    "error_details string, topic string, partition int, offset bigint, original_message string, retry_us bigint"
)
SECOND = 1_000_000


def retry_events(failures: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One stream of both logs. A failed retry is one more failure (``processing_error``
    where the callback raised); a success carries its time only."""
    failed = F.when(F.col("raised"), F.lit("processing_error")).otherwise(F.col("failure_reason"))
    left = failures.select("key", F.lit(False).alias("success"), F.unix_micros("failed_at").alias("at_us"), *DETAILS)
    right = outcomes.select(
        "key", F.coalesce("succeeded", F.lit(False)).alias("success"), F.unix_micros("finished_at").alias("at_us"), "topic", "partition",
        "offset", "value", failed.alias("failure_reason"), F.coalesce("error_message", F.lit("Retry failed")).alias("error_message"),
    )
    return left.unionByName(right)


def _new() -> dict:
    # ``live``: failures, as (time, offset, details), that a success may still cut off.
    # ``old``: count, first and last of those settled before them.
    return {"live": [], "old": None, "reset": None, "announced": None, "seq": 0}


def _place(failure: tuple) -> tuple:
    return failure[:2]


def _settle(held: dict, limit: int) -> None:
    """Folds failures before ``limit``: of these no success will cut off only some."""
    done = [f for f in held["live"] if f[0] < limit]
    if done:
        held["live"] = [f for f in held["live"] if f[0] >= limit]
        old = held["old"]
        n, first, last = old or (0, done[0], done[0])
        held["old"] = (n + len(done), min([first, *done], key=_place), max([last, *done], key=_place))


def _state(held: dict, max_retries: int, delays) -> dict | None:
    """Count, extremes and schedule of a key's live failures; None where there are none."""
    old, live = held["old"], held["live"]
    count = len(live) + (old[0] if old else 0)
    if not count:
        return None
    first = min(([old[1]] if old else []) + live[:1], key=_place)
    last = max(([old[2]] if old else []) + live[-1:], key=_place)
    exhausted = count >= max_retries
    wait = delays[min(count, len(delays)) - 1]
    return {
        "attempt_count": count, "first_us": first[0], "last_us": last[0], "failure_reason": first[2][4], "error_details": last[2][5],
        "topic": first[2][0], "partition": first[2][1], "offset": first[2][2], "original_message": first[2][3],
        "status": "failed" if exhausted else "retry",
        "retry_us": None if exhausted else last[0] // SECOND * SECOND + wait * SECOND,
    }


def retry_steps(max_retries: int, delays, settle_us: int):
    """applyInPandasWithState body: what became of each key, and its retry when it is due."""

    def body(key, batches: Iterator[pd.DataFrame], state: GroupState):
        held = pickle.loads(state.get[0]) if state.exists else _new()
        now = state.getCurrentProcessingTimeMs() * 1000
        out = []

        def say(row: dict) -> None:
            held["seq"] += 1
            out.append({"key": key[0], "seq": held["seq"], **row})

        touched, reset_before = False, held["reset"]
        for batch in ([] if state.hasTimedOut else batches):
            touched = True
            for event in map(json.loads, batch["event"]):
                at = event["at_us"]
                if event.get("success"):
                    held["reset"] = at if held["reset"] is None else max(held["reset"], at)
                else:
                    offset = event.get("offset")
                    held["live"].append((at, -1 if offset is None else offset, tuple(event.get(d) for d in DETAILS)))
        if touched:
            reset = held["reset"]
            if reset is not None:
                held["live"] = [f for f in held["live"] if f[0] > reset]
                if held["old"] and held["old"][2][0] <= reset:
                    held["old"] = None
                elif held["old"] and held["old"][1][0] <= reset and reset != reset_before:
                    # Settled failures lie on both sides of a success that came too late.
                    say({"status": "late_success", "attempt_count": held["old"][0], "last_us": reset})
            held["live"].sort(key=_place)
            newest = held["live"][-1][0] if held["live"] else 0
            _settle(held, newest - settle_us)
        found = _state(held, max_retries, delays)
        if found is None:
            if not touched:  # nothing new for as long as a failure may be reported late
                state.remove()
                return
            say({"status": "cleared", "attempt_count": 0, "last_us": held["reset"]})
            state.setTimeoutDuration(max(1, settle_us // 1000))
        else:
            due = found["retry_us"] is not None and found["retry_us"] <= now
            if due and held["announced"] != found["retry_us"]:
                held["announced"] = found["retry_us"]
                say(found | {"status": "due"})
            elif touched:
                say(found | ({"status": "due"} if due else {}))
            if found["retry_us"] is not None and not due:
                state.setTimeoutDuration(max(1, (found["retry_us"] - now + 999) // 1000))
        state.update((pickle.dumps(held),))
        if out:
            yield pd.DataFrame({"step": [json.dumps(row) for row in out]})

    return body


class RetryQuery(StreamingQuery):
    """Timers keep the query awake with epochs without rows, so Spark's own call would never
    return: all that is there is done when an epoch that began after the call found nothing new."""

    def processAllAvailable(self) -> None:
        seen = self.lastProgress
        known = seen.batchId if seen else None
        while self.isActive:
            seen = self.lastProgress
            if seen and known is None:
                known = seen.batchId - 1
            # The epoch after the last one known may have begun before the call.
            if seen and seen.batchId > known + 1 and all(s.startOffset == s.endOffset for s in seen.sources):
                return
            time.sleep(0.1)
        failed = self.exception()
        if failed is not None:
            raise failed


def start_retry_stream(
    events: DataFrame, path: str, checkpoint: str, generation: int = 0, max_retries: int = MAX_RETRIES,
    delays=RETRY_DELAYS_SECONDS, settle: datetime.timedelta = datetime.timedelta(days=1), fold_every: int = 16, write=None, **options,
) -> StreamingQuery:
    """``events`` as from ``retry_events``. The log at ``path`` gets a row whenever a key
    changes, and one with status ``due`` when the wall clock reaches its retry time.

    Events of a key may come in any order: failures no later than a success do not count,
    whichever arrives first. Failures are held one by one for ``settle`` before the newest
    one and as counts and extremes after that; a success that is reported so late that it
    would split those becomes a row ``late_success``. Every ``fold_every`` epochs the log is
    folded to the newest row per key.
    """
    micros = int(settle / datetime.timedelta(microseconds=1))
    # Python is called once per key and converts every column of every call by itself, so an
    # event and a step travel as one text each.
    packed = events.filter(F.col("key").isNotNull() & F.col("at_us").isNotNull()).select(
        "key", F.to_json(F.struct("success", "at_us", *DETAILS)).alias("event")
    )
    said = packed.groupBy("key").applyInPandasWithState(
        retry_steps(max_retries, tuple(delays), micros), "step string", "held binary", "update", GroupStateTimeout.ProcessingTimeTimeout
    )
    steps = said.select(F.from_json("step", STEP).alias("step")).select("step.*")

    def record(batch: DataFrame, epoch: int) -> None:
        (write or write_epoch)(batch, path, epoch, generation)
        if epoch % fold_every == fold_every - 1:
            fold(batch.sparkSession, path, _newest)

    # Timers keep a query awake with epochs without rows; one that drains what is there and
    # stops must not wait for them.
    conf, idle = events.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(idle)
    if options.get("every", "") is None:
        conf.set(idle, "false")
    try:
        query = start(steps, record, checkpoint, mode="update", **options)
        return RetryQuery(query._jsq) if conf.get(idle) == "true" else query
    finally:
        conf.set(idle, before)


def _newest(log: DataFrame) -> DataFrame:
    kept = latest_rows(log.filter("status <> 'late_success'"), ["key"], [*VERSION, "seq"]).select(*log.columns)
    return kept.unionByName(log.filter("status = 'late_success'"))


def read_retries(spark: SparkSession, path: str) -> DataFrame:
    """The newest row per key: ``retry`` (waiting), ``due``, ``failed`` (no retries left) or
    ``cleared``."""
    log = read_kept(spark, path)
    newest = latest_rows(log.filter("status <> 'late_success'"), ["key"], [*VERSION, "seq"])
    time = lambda name: F.timestamp_micros(name)
    return newest.select(
        "key", "status", "attempt_count", time("first_us").alias("first_failure_time"), time("last_us").alias("last_failure_time"),
        "failure_reason", "error_details", "topic", "partition", "offset", "original_message", time("retry_us").alias("retry_after"),
    )
