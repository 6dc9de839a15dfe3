"""Streaming queries, drained with ``availableNow`` and then read back as tables."""

from __future__ import annotations

import gzip
from datetime import timedelta

from pyspark.sql import functions as F

from eddyline.functions.encoders import md5_encoder
from eddyline.functions.vectors import stored_hash_vector
from eddyline.operators import events as ops
from eddyline.operators.metrics import ALL_LABELS
from eddyline.plans import tables
from eddyline.plans.catalog import hash_vector_columns, plain_time, query, rounded
from eddyline.plans.event_queries import STREAM_SQL
from eddyline.plans.operation_queries import COUNTER_SQL, RATES_SQL, _STATE_SQL, _state_columns, rate_columns
from eddyline.plans.tables import hash_vector_sql, with_sql
from eddyline.session import fresh_folder, tasks_for
from eddyline.schemas import DOCUMENT
from eddyline.sinks.epoch_log import latest_rows, read_log, write_epoch
from eddyline.sinks.points import read_points, upsert_points
from eddyline.sources.documents import list_files, pending_files, stream_documents
from eddyline.streaming import documents, monitors, retries
from eddyline.streaming.pipeline import start, start_point_stream


EPOCHS = 4


def _staged(spark, table, epochs):
    """``table`` as a stream of files, one micro-batch for each condition of ``epochs``.
    Each one is written by as many tasks as the table has splits."""
    source, files = fresh_folder(spark, "event-files"), max(2, table.rdd.getNumPartitions())
    for rows in epochs:
        table.filter(rows).repartition(files).write.mode("append").parquet(source)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(source)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def event_stream(spark, sf_dir):
    """The events table as a stream of ``EPOCHS`` micro-batches, not in the order of time:
    every one holds events of the whole span, so three of four come late."""
    table = tables.table(spark, sf_dir, "events")
    return _staged(spark, table, [F.pmod("event_id", F.lit(EPOCHS)) == k for k in range(EPOCHS)])


def redelivered_stream(spark, sf_dir):
    """The events by quarters of their span, each quarter delivered again with the next one,
    and the first quarter once more at the end."""
    table = tables.table(spark, sf_dir, "events")
    low, high = table.agg(F.min("ts"), F.max("ts")).first()
    quarter = F.least(F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(low).cast("timestamp"))) * EPOCHS
                              / (F.unix_micros(F.lit(high).cast("timestamp")) - F.unix_micros(F.lit(low).cast("timestamp")))), F.lit(EPOCHS - 1))
    return _staged(spark, table, [quarter.isin(*part) for part in ((0,), (0, 1), (1, 2), (2, 3), (3, 0))])


def raw_stream(spark, sf_dir):
    """Kafka-shaped records of the events table."""
    tasks = tasks_for(tables.table(spark, sf_dir, "events").count() // EPOCHS, spark)
    return tables.as_raw(tables.as_events(event_stream(spark, sf_dir), spark, sf_dir, tasks))


def _drain(query):
    query.awaitTermination()


def _run_points(spark, sf_dir):
    folder = fresh_folder(spark, "point-stream")
    _drain(start_point_stream(
        raw_stream(spark, sf_dir), f"{folder}/points", f"{folder}/letters", f"{folder}/checkpoint", every=None
    ))
    return folder


@query("stream_pipeline", with_sql("ev", body=f"""
SELECT event_id AS id, text, product_price, {hash_vector_sql('text')}
FROM (SELECT *, {STREAM_SQL} AS text FROM ev) WHERE eid % 50 <> 0"""))
def stream_pipeline(spark, sf_dir):
    points = read_points(spark, f"{_run_points(spark, sf_dir)}/points")
    return points.select("id", "payload.text", "payload.product_price", *hash_vector_columns())


@query("stream_dead_letters", with_sql("ev", body="""
SELECT CAST(eid % 16 AS INTEGER) AS original_partition, eid AS original_offset, user_id AS original_key,
  'validation_error' AS failure_reason, ts AS failed_at FROM ev WHERE eid % 50 = 0"""))
def stream_dead_letters(spark, sf_dir):
    letters = read_log(spark, f"{_run_points(spark, sf_dir)}/letters")
    return letters.select(
        "original_partition", "original_offset", "original_key", "failure_reason", plain_time("failed_at")
    )


@query("stream_rejects", with_sql("ev", body="""
SELECT CASE WHEN eid % 50 = 0 OR eid % 7 = 1 THEN 'letter' ELSE 'point' END AS kind,
  CASE WHEN eid % 50 = 0 THEN 'malformed JSON' WHEN eid % 7 = 1 THEN 'not a vector of 384 finite cells' END AS why,
  count(*) AS n FROM ev GROUP BY ALL"""))
def stream_rejects(spark, sf_dir):
    """Every 11th event has lost its id, every 7th text gives a vector that does not fit:
    what is no point is a letter, and no two events without an id are one point."""
    folder = fresh_folder(spark, "reject-stream")
    raw = raw_stream(spark, sf_dir)
    place, value = F.col("offset"), F.col("value").cast("string")
    without = F.regexp_replace(value, r'"event_id":"\d+",', "")
    spoiled = raw.withColumn("value", F.when(F.pmod(place, F.lit(11)) == 0, without).otherwise(value).cast("binary"))

    def vector(text, width):
        fit = stored_hash_vector(text, width)
        kind = F.pmod("offset", F.lit(7))
        return F.when(kind != 1, fit).when(F.pmod("offset", F.lit(3)) == 0, F.slice(fit, 1, 1)).when(
            F.pmod("offset", F.lit(3)) == 1, F.transform(fit, lambda x: F.lit(float("nan")).cast("float"))
        )

    _drain(start_point_stream(spoiled, f"{folder}/points", f"{folder}/letters", f"{folder}/checkpoint", vector=vector, every=None))
    points = read_points(spark, f"{folder}/points").select(F.lit("point").alias("kind"), F.lit(None).cast("string").alias("why"))
    letters = read_log(spark, f"{folder}/letters").select(F.lit("letter").alias("kind"), F.col("error_message").alias("why"))
    return points.unionByName(letters).groupBy("kind", "why").agg(F.count("*").alias("n"))


@query("encoded_points", with_sql("ev", body=f"""
SELECT event_id AS id, text, {hash_vector_sql('text')}
FROM (SELECT *, {STREAM_SQL} AS text FROM ev) WHERE eid % 50 <> 0"""))
def encoded_points(spark, sf_dir):
    """The point stream with an encoder in place of the hash expression."""
    folder = fresh_folder(spark, "encoder-stream")
    _drain(start_point_stream(
        raw_stream(spark, sf_dir), f"{folder}/points", f"{folder}/letters", f"{folder}/checkpoint", encoder=md5_encoder, every=None
    ))
    return read_points(spark, f"{folder}/points").select("id", "payload.text", *hash_vector_columns())


@query("stream_parse", with_sql("ev", body="""
SELECT eid AS "offset", event_id, event_type, product_name, search_query, quantity FROM ev WHERE eid % 50 <> 0"""))
def stream_parse(spark, sf_dir):
    folder = fresh_folder(spark, "parse-stream")
    parsed = ops.parse_events(raw_stream(spark, sf_dir))
    write = lambda batch, epoch: write_epoch(batch, folder, epoch)
    _drain(start(parsed, write, f"{folder}/checkpoint", every=None))
    return read_log(spark, folder).select(
        "offset", "event_id", "event_type", F.col("product.name").alias("product_name"), "search_query", "quantity"
    )


@query("stream_upsert", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY user_id""")
def stream_upsert(spark, sf_dir):
    """Last write wins per user, by event time: the stream's epochs go through the points
    table, the second one twice, as if it had been replayed."""
    folder = fresh_folder(spark, "upsert-stream")
    rows = event_stream(spark, sf_dir).select("user_id", "event_id", "ts")

    def write(batch, epoch):
        newest = F.max(F.struct("ts", "event_id")).alias("newest")
        points = batch.groupBy(F.col("user_id").cast("string").alias("id")).agg(newest)
        points = points.select("id", F.struct("newest.event_id", "newest.ts").alias("payload"), F.unix_micros("newest.ts").alias("offset"))
        for _ in range(1 + (epoch == 1)):
            upsert_points(points, f"{folder}/points", epoch)

    _drain(start(rows, write, f"{folder}/checkpoint", every=None))
    log = read_log(spark, f"{folder}/points")
    latest = latest_rows(log, ["id"], ["payload.ts", "payload.event_id"])
    return latest.select(F.col("id").cast("bigint").alias("user_id"), "payload.event_id", F.col("payload.ts").cast("timestamp_ntz").alias("ts"))


@query("stream_rates", RATES_SQL)
def stream_rates(spark, sf_dir):
    folder = fresh_folder(spark, "rate-stream")
    _drain(monitors.start_rate_stream(
        event_stream(spark, sf_dir), "ts", ["event_type"], f"{folder}/steps", f"{folder}/checkpoint", every=None
    ))
    return rate_columns(monitors.read_rates(spark, f"{folder}/steps", ["event_type"]))


@query("stream_dlq_state", with_sql("fail", "state", body=_STATE_SQL + "state"))
def stream_dlq_state(spark, sf_dir):
    folder = fresh_folder(spark, "failure-stream")
    _drain(monitors.start_failure_stream(
        tables.as_failures(event_stream(spark, sf_dir)), f"{folder}/state", f"{folder}/checkpoint", every=None
    ))
    return _state_columns(monitors.read_failures(spark, f"{folder}/state"))


@query("stream_counters", COUNTER_SQL)
def stream_counters(spark, sf_dir):
    folder, labels = fresh_folder(spark, "counter-stream"), list(ALL_LABELS)
    _drain(monitors.start_counter_stream(
        tables.as_op_log(event_stream(spark, sf_dir)), labels, f"{folder}/totals", f"{folder}/checkpoint", every=None
    ))
    return monitors.read_counters(spark, f"{folder}/totals", labels)


@query("stream_dedupe", """
WITH span AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events)
SELECT event_id, ts, event_type, round(value, 6) AS value,
  CASE WHEN (epoch_us(ts) - lo) * 4 < hi - lo THEN 1 ELSE 0 END AS late_copies
FROM events, span""")
def stream_dedupe(spark, sf_dir):
    """Every event is delivered twice and comes out once. The first quarter comes a third
    time, when it is forgotten, and its rows are letters then."""
    folder = fresh_folder(spark, "dedupe-stream")
    events = redelivered_stream(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    low, high = tables.table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    ttl = int((high - low).total_seconds() * 0.3)
    _drain(monitors.start_dedupe_stream(
        events, "event_id", "ts", f"{folder}/events", f"{folder}/checkpoint", ttl=f"{ttl} seconds", every=None
    ))
    late = monitors.read_late(spark, f"{folder}/events").groupBy("event_id").agg(F.count("*").cast("int").alias("late_copies"))
    once = monitors.read_unique(spark, f"{folder}/events").join(late, "event_id", "left")
    return once.select("event_id", plain_time("ts"), "event_type", rounded("value"), F.coalesce("late_copies", F.lit(0)).alias("late_copies"))


@query("stream_dedupe_balance", """
WITH span AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
counted AS (SELECT count(*) AS n, count(*) FILTER ((epoch_us(ts) - lo) * 4 < hi - lo) AS first FROM events, span)
SELECT (2 * n + first)::BIGINT AS rows_in, n AS rows_out, n AS repeats, first AS late FROM counted""")
def stream_dedupe_balance(spark, sf_dir):
    """Rows in = rows out + repeats + late ones, as the epochs of ``stream_dedupe`` add up."""
    folder = fresh_folder(spark, "dedupe-balance")
    events = redelivered_stream(spark, sf_dir).select("event_id", "ts")
    low, high = tables.table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    ttl = int((high - low).total_seconds() * 0.3)
    _drain(monitors.start_dedupe_stream(
        events, "event_id", "ts", f"{folder}/events", f"{folder}/checkpoint", ttl=f"{ttl} seconds", fold_every=2, every=None
    ))
    balance = monitors.read_balance(spark, f"{folder}/events")
    return balance.agg(*[F.sum(c).alias(c) for c in ("rows_in", "rows_out", "repeats", "late")])


@query("stream_due_retries", with_sql("fail", "outc", body="""
, resets AS (SELECT key, max(finished_at) AS reset_at FROM outc WHERE succeeded GROUP BY key),
log AS (
  SELECT key, "offset", failure_reason, error_message, failed_at FROM fail UNION ALL
  SELECT key, "offset", CASE WHEN raised THEN 'processing_error' ELSE 'timeout_error' END, 'Retry failed', finished_at
  FROM outc WHERE NOT succeeded),
live AS (SELECT log.* FROM log LEFT JOIN resets USING (key) WHERE reset_at IS NULL OR failed_at > reset_at)
SELECT key, count(*) AS attempt_count, min(failed_at) AS first_failure_time, max(failed_at) AS last_failure_time,
  arg_min(failure_reason, (failed_at, "offset")) AS failure_reason,
  arg_max(error_message, (failed_at, "offset")) AS error_details,
  arg_min("offset", (failed_at, "offset")) AS "offset", 'due' AS status,
  date_trunc('second', max(failed_at)) + to_seconds([60, 300, 900][least(count(*), 3)]) AS retry_after
FROM live GROUP BY key HAVING count(*) < 3"""))
def stream_due_retries(spark, sf_dir):
    """Failures and outcomes of retries in four epochs, none in order of time and the second
    one written twice; what is due are the retries of the batch form whose time has come."""
    folder = fresh_folder(spark, "retry-stream")
    events = event_stream(spark, sf_dir)
    both = retries.retry_events(tables.as_failures(events), tables.as_outcomes(events))

    def write(batch, path, epoch, generation):
        for _ in range(1 + (epoch == 1)):
            write_epoch(batch, path, epoch, generation)

    _drain(retries.start_retry_stream(
        both, f"{folder}/log", f"{folder}/checkpoint", settle=timedelta(days=3650), fold_every=2, write=write, every=None
    ))
    due = retries.read_retries(spark, f"{folder}/log").filter("status = 'due'")
    return _state_columns(due)


@query("document_epochs", """
SELECT sha256(text) AS content, 1 AS points FROM documents
WHERE text IS NOT NULL AND text <> '' AND text <> ' ' AND length(text) > 10 GROUP BY text""")
def document_epochs(spark, sf_dir):
    """Documents in four epochs, a third of them again under other ids in the next one: each
    content is stored once, whichever epochs hold it."""
    folder = fresh_folder(spark, "document-epochs")
    docs = tables.documents(spark, sf_dir).select("doc_id", "id", "content")
    files, epoch = max(2, docs.rdd.getNumPartitions()), lambda k: F.pmod("doc_id", F.lit(EPOCHS)) == k
    for k in range(EPOCHS):
        again = docs.filter(epoch((k - 1) % EPOCHS) & (F.pmod("doc_id", F.lit(3)) == 0)).withColumn("id", F.concat(F.lit("copy of "), "id"))
        docs.filter(epoch(k)).unionByName(again).drop("doc_id").repartition(files).write.mode("append").json(f"{folder}/in")
    stream = stream_documents(spark, f"{folder}/in", DOCUMENT, maxFilesPerTrigger=str(files))
    _drain(documents.start_document_stream(
        documents.with_file(stream), f"{folder}/points", f"{folder}/json", f"{folder}/ledger",
        f"{folder}/checkpoint", strict=True, dedupe=True, fold_every=3, every=None,
    ))
    stored = read_points(spark, f"{folder}/points").groupBy(F.sha2("payload.content", 256).alias("content"))
    return stored.agg(F.count("*").cast("int").alias("points"))


@query("document_batch", """
SELECT source, 'success' AS status, count(*) AS records,
  count(*) FILTER (text IS NOT NULL AND text <> '' AND text <> ' ' AND length(text) > 10) AS points, 0 AS waiting
FROM documents GROUP BY source UNION ALL SELECT 'broken', 'error', 0, 0, 1""")
def document_batch(spark, sf_dir):
    """Document files of every source, one of them cut short, through the whole batch path;
    then ledger, points and the files that still wait."""
    folder = fresh_folder(spark, "document-batch")
    docs = tables.documents(spark, sf_dir).select("id", "content", "source")
    docs.write.partitionBy("source").json(f"{folder}/in")
    _write_bytes(spark, f"{folder}/in/source=broken/part.json.gz", gzip.compress(b'{"id": "x", "content": "never stored"}\n' * 9)[:40])
    glob = "*.{json,jsonl,gz}"
    stream = stream_documents(spark, f"{folder}/in", DOCUMENT, glob, recursiveFileLookup="true")
    _drain(documents.start_document_stream(
        documents.with_file(stream), f"{folder}/points", f"{folder}/json", f"{folder}/ledger",
        f"{folder}/checkpoint", strict=True, every=None,
    ))
    source = lambda file: F.regexp_extract(file, "source=([^/]+)/", 1).alias("source")
    files = list_files(spark, f"{folder}/in", glob)
    ledger = documents.read_ledger(spark, f"{folder}/ledger", files)
    entered = ledger.groupBy(source("file"), "status").agg(F.sum("record_count").alias("records"))
    stored = read_points(spark, f"{folder}/points").groupBy(source("payload.file")).agg(F.count("*").alias("points"))
    waiting = pending_files(files, ledger).groupBy(source("path")).agg(F.count("*").cast("int").alias("waiting"))
    counted = entered.join(stored, "source", "left").join(waiting, "source", "left")
    return counted.withColumn("points", F.coalesce("points", F.lit(0))).withColumn("waiting", F.coalesce("waiting", F.lit(0)))


def _write_bytes(spark, path, content):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    stream.write(bytearray(content))
    stream.close()
