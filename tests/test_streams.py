"""Streams equal their batch twins on the same rows, whatever the cut into batches."""

import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from eddyline.operators import events as ops
from eddyline.operators.metrics import ALL_LABELS, counter_table, sliding_rates
from eddyline.plans import tables
from eddyline.session import fresh_folder
from eddyline.sinks.epoch_log import epochs, fold, read_kept, read_log, write_epoch
from eddyline.sinks.points import read_points
from eddyline.streaming import monitors
from eddyline.streaming.pipeline import start, start_point_stream

SF = "/root/testdata/sf0.001"


def as_stream(spark, df, files=4):
    """The rows in several files, one per micro-batch."""
    folder = fresh_folder(spark, "source")
    df.repartition(files).write.parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def rows(df):
    return sorted(map(str, df.collect()))


def test_point_stream(spark):
    raw = tables.raw_records(spark, SF)
    folder = fresh_folder(spark, "points")
    start_point_stream(as_stream(spark, raw), f"{folder}/p", f"{folder}/d", f"{folder}/c", every=None).awaitTermination()
    stored = read_points(spark, f"{folder}/p")
    assert stored.select("epoch_id").distinct().count() == 4
    batch = ops.events_to_points(ops.parse_events(raw), carry=("offset",))
    assert rows(stored.select("id", "vector", "payload", "offset")) == rows(batch)
    decoded = ops.decode_events(raw)
    letters = ops.malformed_letters(decoded, F.col("kafka_timestamp"))
    assert rows(read_log(spark, f"{folder}/d").drop("generation", "epoch_id")) == rows(letters)


def test_rate_stream(spark):
    events = tables.table(spark, SF, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    folder = fresh_folder(spark, "rates")
    # The files are not in time order: the delay must cover the whole span.
    monitors.start_rate_stream(
        as_stream(spark, events), "ts", ["event_type"], f"{folder}/s", f"{folder}/c", every=None
    ).awaitTermination()
    assert rows(monitors.read_rates(spark, f"{folder}/s", ["event_type"])) == rows(sliding_rates(events, "ts", ["event_type"]))


def test_counter_stream_over_two_generations(spark):
    log = tables.op_log(spark, SF)
    folder, names = fresh_folder(spark, "counters"), list(ALL_LABELS)
    for generation, part in enumerate((log.filter("batch_size < 3000"), log.filter("batch_size >= 3000"))):
        monitors.start_counter_stream(
            as_stream(spark, part), names, f"{folder}/t", f"{folder}/c{generation}", generation, every=None
        ).awaitTermination()
    assert rows(monitors.read_counters(spark, f"{folder}/t", names)) == rows(counter_table(log))


def batches(spark, parts, schema):
    """Each list of rows as one file, hence one epoch, in the given order."""
    folder = fresh_folder(spark, "source")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def at(minute, second=0):
    return datetime.datetime(2024, 1, 1, 0, 0, second) + datetime.timedelta(minutes=minute)


def test_redelivered_events_come_out_once(spark):
    events = tables.table(spark, SF, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id")
    folder = fresh_folder(spark, "dedupe")
    monitors.start_dedupe_stream(
        as_stream(spark, events.unionAll(events)), "event_id", "ts", f"{folder}/e", f"{folder}/c", ttl="3650 days", every=None
    ).awaitTermination()
    assert rows(monitors.read_unique(spark, f"{folder}/e").select("ts", "event_id")) == rows(events)


def test_what_is_too_late_is_a_letter_and_memory_is_bounded(spark):
    parts = [
        [(1, at(0), {"a": "x"}), (1, at(0), {"a": "x"}), (None, at(0), None), (None, at(0), None), (9, None, None)],
        [(1, at(1), None), (2, at(20), None)],
        [(1, at(2), None), (3, at(2), None), (2, at(20), None), (None, at(1), None), (9, None, None)],
        *[[(100 + k, at(40 + k), None), (99 + k, at(39 + k), None)] for k in range(3)],
    ]
    folder = fresh_folder(spark, "late")
    monitors.start_dedupe_stream(
        batches(spark, parts, "id int, ts timestamp, more map<string,string>"), "id", "ts", f"{folder}/e", f"{folder}/c", ttl="10 minutes", fold_every=2, every=None
    ).awaitTermination()
    once, late = monitors.read_unique(spark, f"{folder}/e"), monitors.read_late(spark, f"{folder}/e")
    assert sorted((r.id or 0, r.ts or at(-1)) for r in late.collect()) == [(0, at(1)), (1, at(2)), (3, at(2))]
    kept = sorted(r.id or 0 for r in once.collect())
    assert kept == sorted([0, 0, 1, 2, 9, *range(99, 103)])
    balance = monitors.read_balance(spark, f"{folder}/e")
    total = balance.agg(*[F.sum(c) for c in ("rows_in", "rows_out", "repeats", "late")]).first()
    assert total[0] == sum(map(len, parts)) == total[1] + total[2] + total[3] and total[3] == 3
    # What is remembered does not grow with the epochs: a fold of the live keys, and few epochs.
    assert len(epochs(spark, f"{folder}/e/keys")) <= 2 and read_kept(spark, f"{folder}/e/keys").count() <= 8


def test_folded_logs_read_the_same(spark):
    from eddyline.operators.deadletters import fold_failures

    log, names, folder = tables.op_log(spark, SF), list(ALL_LABELS), fresh_folder(spark, "folds")
    events = tables.table(spark, SF, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    failures = tables.failures(spark, SF)
    monitors.start_counter_stream(as_stream(spark, log, 3), names, f"{folder}/t", f"{folder}/c", fold_every=2, every=None).awaitTermination()
    monitors.start_rate_stream(as_stream(spark, events, 3), "ts", ["event_type"], f"{folder}/s", f"{folder}/d", fold_every=2, every=None).awaitTermination()
    monitors.start_failure_stream(as_stream(spark, failures, 3), f"{folder}/f", f"{folder}/g", fold_every=2, every=None).awaitTermination()
    assert all(len(epochs(spark, f"{folder}/{n}")) <= 2 for n in "tsf")
    assert rows(monitors.read_counters(spark, f"{folder}/t", names)) == rows(counter_table(log))
    assert rows(monitors.read_rates(spark, f"{folder}/s", ["event_type"])) == rows(sliding_rates(events, "ts", ["event_type"]))
    assert rows(monitors.read_failures(spark, f"{folder}/f")) == rows(fold_failures(failures))


def test_a_fold_that_did_not_finish_is_not_read(spark):
    folder = fresh_folder(spark, "unfinished")
    for epoch in range(3):
        write_epoch(spark.range(epoch + 1), folder, epoch)
    spark.range(99).write.parquet(f"{folder}/folded/0-1")
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/folded/0-1/_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).delete(marker, False)
    assert read_kept(spark, folder).count() == 6 and read_kept(spark, folder, before=(0, 2)).count() == 3
    assert fold(spark, folder, lambda log: log) == 2 and read_kept(spark, folder).count() == 6
    write_epoch(spark.range(10), folder, 2)  # the newest epoch written again
    assert fold(spark, folder, lambda log: log) == 0 and read_kept(spark, folder).count() == 13
    assert read_kept(spark, fresh_folder(spark, "none")) is None


def test_digest_index_opens_only_what_filters_know(spark):
    from eddyline.sinks import digest_index as index

    folder = fresh_folder(spark, "digests")
    digests = lambda a, b: spark.range(a, b).select(index.content_digest(F.col("id").cast("string")).alias("digest"))
    for epoch in range(4):
        index.add_digests(digests(epoch * 1000, epoch * 1000 + 1000), folder, epoch, per_bucket=64)
    index.add_digests(digests(3000, 4000), folder, 3, per_bucket=64)  # written again
    asked = digests(1990, 2010).unionByName(digests(9000, 9020))
    assert index.known_digests(spark, folder, asked, (0, 4)).count() == 20
    assert index.known_digests(spark, folder, asked, (0, 2)).count() == 10  # of epochs before only
    assert index.known_digests(spark, folder, digests(9000, 9003), (0, 4)).count() == 0
    segments = list(index.segments(spark, folder).values())
    opened = index.buckets_to_open(index.suspects(spark, digests(1990, 1992), segments))
    every = spark.read.option("recursiveFileLookup", True).parquet(*[f"{s}/digests" for s in segments]).select(F.input_file_name()).distinct().count()
    assert 1 <= len(opened) <= 6 and every >= 60
    assert index.fold_digests(spark, folder, per_bucket=64) == 3 and len(index.segments(spark, folder)) == 2
    assert index.known_digests(spark, folder, asked, (0, 4)).count() == 20
    assert index.fold_digests(spark, folder) == 0
    assert index.known_digests(spark, fresh_folder(spark, "none"), asked, (0, 4)).count() == 0
    null = spark.createDataFrame([(None,), ("",)], "c string").select(index.content_digest(F.col("c")).alias("d"))
    assert null.distinct().count() == 2


def test_documents_are_stored_once_across_epochs(spark):
    from eddyline.streaming import documents

    folder = fresh_folder(spark, "doc-epochs")
    texts = [("a", "the same text"), ("b", "another text")], [("c", "the same text"), ("d", "third text")], [("e", "third text"), ("a", "the same text"), ("f", "fourth")]
    for part in texts:
        spark.createDataFrame(part, "id string, content string").coalesce(1).write.mode("append").json(f"{folder}/in")
    from eddyline.schemas import DOCUMENT
    from eddyline.sources.documents import stream_documents

    stream = documents.with_file(stream_documents(spark, f"{folder}/in", DOCUMENT, maxFilesPerTrigger="1"))
    documents.start_document_stream(
        stream, f"{folder}/p", f"{folder}/j", f"{folder}/l", f"{folder}/c", dedupe=True, fold_every=2, every=None
    ).awaitTermination()
    assert sorted(r.id for r in read_points(spark, f"{folder}/p").collect()) == ["a", "b", "d", "f"]


def failure(key, minute, reason="timeout_error", error="e", offset=1):
    return (key, "t", 0, offset, "v", reason, error, at(minute))


FAILURES = "key string, topic string, partition int, offset bigint, value string, failure_reason string, error_message string, failed_at timestamp"
OUTCOMES = FAILURES.replace("failed_at", "finished_at") + ", succeeded boolean, raised boolean"


def run_retries(spark, failures, outcomes, **more):
    from eddyline.streaming.retries import read_retries, retry_events, start_retry_stream

    folder = fresh_folder(spark, "retries")
    parts = zip(failures, outcomes)
    union = [retry_events(spark.createDataFrame(f, FAILURES), spark.createDataFrame(o, OUTCOMES)).collect() for f, o in parts]
    from eddyline.streaming.retries import EVENT

    source = fresh_folder(spark, "source")
    for part in union:
        spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(source)
    query = start_retry_stream(stream, f"{folder}/r", f"{folder}/c", **more)
    return query, lambda: {r.key: r for r in read_retries(spark, f"{folder}/r").collect()}, folder


def test_retries_come_out_when_due_and_outcomes_reset_them(spark):
    done = lambda key, minute, good, raised=False: (*failure(key, minute), good, raised)
    failures = [
        [failure("once", 0), failure("healed", 0), failure("early", 5), failure("often", 2, "network_error", "last", 3)],
        [failure("often", 0, "parse_error", "first"), failure("often", 1), failure("again", 0), failure(None, 0)],
        [failure("again", 9, "network_error", "new")],
    ]
    outcomes = [[done("early", 6, True)], [done("healed", 1, True), done("once", 3, False, True)], [done("again", 5, True), done("early", 1, True)]]
    query, read, _ = run_retries(spark, failures, outcomes, every=None)
    query.awaitTermination()
    got = read()
    assert {k: (r.status, r.attempt_count) for k, r in got.items()} == {
        "once": ("due", 2), "healed": ("cleared", 0), "early": ("cleared", 0), "often": ("failed", 3), "again": ("due", 1),
    }
    assert got["often"].failure_reason == "parse_error" and got["often"].error_details == "last" and got["often"].retry_after is None
    assert got["again"].failure_reason == "network_error" and got["again"].retry_after == at(10)
    assert got["once"].retry_after == at(3) + datetime.timedelta(minutes=5)


def test_a_retry_waits_for_its_timer(spark):
    import time

    now = datetime.datetime.now().replace(microsecond=0)
    fails = [[("k", "t", 0, 1, "v", "timeout_error", "e", now)]]
    query, read, folder = run_retries(spark, fails, [[]], delays=(12,), every="1 second")
    try:
        query.processAllAvailable()
        assert read()["k"].status == "retry"
        for _ in range(60):
            time.sleep(1)
            if read()["k"].status == "due":
                break
        assert read()["k"].status == "due" and datetime.datetime.now() >= now + datetime.timedelta(seconds=12)
    finally:
        query.stop()


def test_settled_failures_and_a_success_that_comes_too_late(spark):
    failures = [[failure("k", m) for m in range(0, 50, 10)], [failure("k", 60)], [failure("k", 61)]]
    success = (*failure("k", 15), True, False)
    query, read, folder = run_retries(spark, failures, [[], [success], []], settle=datetime.timedelta(minutes=15), max_retries=99, delays=(60,), every=None)
    query.awaitTermination()
    said = [r.status for r in read_log(spark, f"{folder}/r").orderBy("seq").collect()]
    assert said.count("late_success") == 1 and read()["k"].attempt_count == 7


def test_a_failed_write_is_not_committed(spark):
    source, folder = spark.range(10), fresh_folder(spark, "fail")
    stream = as_stream(spark, source, files=1)

    def broken(batch, epoch):
        raise RuntimeError("store is down")

    with pytest.raises(StreamingQueryException):
        start(stream, broken, f"{folder}/c", every=None).awaitTermination()
    # The same checkpoint delivers the batch again once the store works.
    start(stream, lambda b, e: write_epoch(b, f"{folder}/out", e), f"{folder}/c", every=None).awaitTermination()
    assert read_log(spark, f"{folder}/out").count() == 10


def test_no_record_is_lost(spark):
    """Input = points + letters, with lost ids, odd vectors and an encoder that fails."""
    import numpy as np

    raw = tables.raw_records(spark, SF)
    text = F.col("value").cast("string")
    raw = raw.withColumn("value", F.when(F.col("offset") % 11 == 0, F.regexp_replace(text, r'"event_id":"\d+",', "")).otherwise(text).cast("binary"))

    def shaky():
        def encode(texts):
            if any("view" in t for t in texts) and len(texts) > 1:
                return [np.ones(384)]
            return [np.ones(3) if "click" in t else np.full(384, np.nan) if "error" in t else np.ones(384) for t in texts]

        return encode

    folder = fresh_folder(spark, "lossless")
    start_point_stream(as_stream(spark, raw), f"{folder}/p", f"{folder}/d", f"{folder}/c", encoder=shaky, every=None).awaitTermination()
    points, letters = read_points(spark, f"{folder}/p"), read_log(spark, f"{folder}/d")
    assert points.count() + letters.count() == raw.count()
    assert {r.failure_reason for r in letters.select("failure_reason").distinct().collect()} == {"validation_error", "embedding_error"}
    assert letters.filter("original_value IS NULL").count() == 0 and points.filter("id IS NULL OR id = ''").count() == 0


def test_retention_of_epochs(spark):
    from eddyline.sinks.epoch_log import drop_epochs

    folder = fresh_folder(spark, "retention")
    for epoch in range(4):
        write_epoch(spark.range(epoch + 1), folder, epoch)
    assert drop_epochs(spark, folder, before=2) == 2 and epochs(spark, folder) == [(0, 2), (0, 3)]
    assert read_log(spark, folder).count() == 7


def test_an_event_and_a_step_are_one_column_each():
    """What a key's call converts is one text per event; 98 s against 50 s at six times sf0.1."""
    import json

    import pandas as pd

    from eddyline.streaming.retries import retry_steps

    class State:
        exists = hasTimedOut = False
        get, kept, wait = None, None, None
        getCurrentProcessingTimeMs = staticmethod(lambda: 10_000)

        def update(self, kept):
            self.kept = kept

        def setTimeoutDuration(self, wait):
            self.wait = wait

    state, event = State(), {"success": False, "at_us": 5_000_000, "topic": "t", "offset": 7, "failure_reason": "r", "error_message": 'é"\n'}
    said = list(retry_steps(3, (60,), 1)(("k",), iter([pd.DataFrame({"event": [json.dumps(event)]})]), state))
    assert [list(frame.columns) for frame in said] == [["step"]]
    row = json.loads(said[0]["step"][0])
    assert (row["key"], row["status"], row["offset"], row["error_details"], row["partition"]) == ("k", "retry", 7, 'é"\n', None)
    assert row["retry_us"] == 65_000_000 and state.wait == 55_000 and state.kept
