"""Queries over dead letters, the file ledger and operational metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from eddyline.functions import labels
from eddyline.operators import deadletters as dlq
from eddyline.operators import ledger as led
from eddyline.operators import metrics
from eddyline.operators.sets import union_letters
from eddyline.plans import tables
from eddyline.plans.catalog import plain_time, query, rounded
from eddyline.plans.tables import with_sql
from eddyline.schemas import DEAD_LETTER, HISTOGRAM_EDGES
from eddyline.session import fresh_folder
from eddyline.sources.kafka import dead_letter_records as records

NOW = "2024-01-20 12:00:00"
NOW_SQL = f"TIMESTAMP '{NOW}'"


def _now():
    return F.lit(NOW).cast("timestamp")


def _state(spark, sf_dir):
    return dlq.fold_failures(tables.failures(spark, sf_dir))


def _state_columns(state):
    return state.select(
        "key", "attempt_count", plain_time("first_failure_time"), plain_time("last_failure_time"),
        "failure_reason", "error_details", "offset", "status", plain_time("retry_after"),
    )


_STATE_SQL = """
SELECT key, attempt_count, first_failure_time, last_failure_time, failure_reason, error_details, "offset", status,
  retry_after FROM """


@query("dead_letter_rows", with_sql("fail", body="""
SELECT 'ecommerce-events' AS original_topic, partition AS original_partition, "offset" AS original_offset,
  key AS original_key, value AS original_value, failure_reason, error_message, failed_at, 0 AS retry_count
FROM fail"""))
def dead_letter_rows(spark, sf_dir):
    letters = dlq.dead_letter_rows(
        tables.failures(spark, sf_dir), F.col("failure_reason"), F.col("error_message"), F.col("failed_at")
    )
    return letters.withColumn("failed_at", plain_time("failed_at")).drop("original_headers")


@query("dlq_state", with_sql("fail", "state", body=_STATE_SQL + "state"))
def dlq_state(spark, sf_dir):
    return _state_columns(_state(spark, sf_dir))


@query("dlq_state_roundtrip", with_sql("fail", "state", body="""
SELECT key, attempt_count, first_failure_time, last_failure_time, failure_reason, error_details, "offset", status,
  retry_after, 1 AS bad_lines FROM state"""))
def dlq_state_roundtrip(spark, sf_dir):
    """The state saved as JSON lines, one of them broken later, and read again."""
    folder = fresh_folder(spark, "dlq-state")
    dlq.write_state(_state(spark, sf_dir), folder)
    broken = tables.failures(spark, sf_dir).agg(F.concat(F.lit('{"id": "'), F.min("key")).alias("value"))
    broken.write.mode("append").text(folder)
    rows, bad = dlq.read_state(spark, folder)
    return _state_columns(rows).withColumn("bad_lines", F.lit(bad.count()).cast("int"))


@query("dead_letter_records", with_sql("fail", body="""
SELECT 'dead-letter-queue' AS topic, key, "offset" AS original_offset, failure_reason, value AS original_value FROM fail"""))
def dead_letter_records(spark, sf_dir):
    """What the Kafka sink would be given; the letter is read back out of the JSON value."""
    letters = dlq.dead_letter_rows(
        tables.failures(spark, sf_dir), F.col("failure_reason"), F.col("error_message"), F.col("failed_at")
    )
    letter = F.from_json("value", DEAD_LETTER).alias("l")
    return records(letters).select("topic", "key", letter).select(
        "topic", "key", "l.original_offset", "l.failure_reason", "l.original_value"
    )


@query("dlq_due", with_sql("fail", "state", body=f"""
SELECT key, first_failure_time, retry_after FROM state WHERE status = 'retry' AND retry_after <= {NOW_SQL}
ORDER BY first_failure_time, key"""))
def dlq_due(spark, sf_dir):
    due = dlq.due_retries(_state(spark, sf_dir), _now())
    return due.select("key", plain_time("first_failure_time"), plain_time("retry_after"))


@query("dlq_after_retry", with_sql("fail", "outc", body="""
, resets AS (SELECT key, max(finished_at) AS reset_at FROM outc WHERE succeeded GROUP BY key),
log AS (
  SELECT key, "offset", failure_reason, error_message, failed_at FROM fail UNION ALL
  SELECT key, "offset", CASE WHEN raised THEN 'processing_error' ELSE 'timeout_error' END, 'Retry failed', finished_at
  FROM outc WHERE NOT succeeded),
live AS (SELECT log.* FROM log LEFT JOIN resets USING (key) WHERE reset_at IS NULL OR failed_at > reset_at)
SELECT key, count(*) AS attempt_count, min(failed_at) AS first_failure_time, max(failed_at) AS last_failure_time,
  arg_min(failure_reason, (failed_at, "offset")) AS failure_reason,
  arg_max(error_message, (failed_at, "offset")) AS error_details,
  arg_min("offset", (failed_at, "offset")) AS "offset",
  CASE WHEN count(*) >= 3 THEN 'failed' ELSE 'retry' END AS status,
  CASE WHEN count(*) < 3 THEN date_trunc('second', max(failed_at))
    + to_seconds([60, 300, 900][least(count(*), 3)]) END AS retry_after
FROM live GROUP BY key"""))
def dlq_after_retry(spark, sf_dir):
    state = dlq.fold_with_outcomes(tables.failures(spark, sf_dir), tables.outcomes(spark, sf_dir))
    return _state_columns(state)


@query("dlq_filter", with_sql("fail", "state", body=_STATE_SQL + """state
WHERE failure_reason = 'timeout_error' AND status = 'retry'"""))
def dlq_filter(spark, sf_dir):
    chosen = dlq.filter_letters(_state(spark, sf_dir), reason="timeout_error", status="retry")
    return _state_columns(chosen)


@query("dlq_all", with_sql("fail", "state", body="SELECT key, status FROM state"))
def dlq_all(spark, sf_dir):
    state = _state(spark, sf_dir)
    both = union_letters(dlq.filter_letters(state, status="failed"), dlq.filter_letters(state, status="retry"))
    return both.select("key", "status")


@query("dlq_replay", with_sql("fail", body=f"""
SELECT 'replay-topic' AS topic, key, value, 'true' AS replay, '2024-01-20T12:00:00Z' AS replay_at,
  failure_reason AS original_failure_reason, '7' AS trace
FROM fail WHERE failure_reason = 'processing_error'"""))
def dlq_replay(spark, sf_dir):
    failed = dlq.filter_letters(tables.failures(spark, sf_dir), reason="processing_error")
    letters = dlq.dead_letter_rows(
        failed, F.col("failure_reason"), F.col("error_message"), F.col("failed_at"),
        headers=F.create_map(F.lit("trace"), F.lit("7"), F.lit("dlq_replay"), F.lit("old")),
    )
    h = F.col("headers")
    return dlq.replay_records(letters, _now(), "replay-topic").select(
        "topic", "key", "value", h["dlq_replay"].alias("replay"), h["dlq_replay_at"].alias("replay_at"),
        h["original_failure_reason"].alias("original_failure_reason"), h["trace"].alias("trace"),
    )


@query("dlq_after_replay", with_sql("fail", "state", body=_STATE_SQL + """state
WHERE NOT (failure_reason = 'processing_error' AND attempt_count <= 2)"""))
def dlq_after_replay(spark, sf_dir):
    state = _state(spark, sf_dir)
    replayed = dlq.replayable(state, "processing_error", max_retry_count=2)
    return _state_columns(dlq.without_replayed(state, replayed))


@query("dlq_page", with_sql("fail", "state", body="""
SELECT key, first_failure_time, total_count, has_more FROM (
  SELECT key, first_failure_time, count(*) OVER () AS left_count,
    (SELECT count(*) FROM state) AS total_count, count(*) OVER () > 10 AS has_more
  FROM state WHERE (first_failure_time, key) > (TIMESTAMP '2024-01-10 00:00:00', ''))
ORDER BY first_failure_time, key LIMIT 10"""))
def dlq_page(spark, sf_dir):
    page = dlq.letter_page(_state(spark, sf_dir), limit=10, after=("2024-01-10 00:00:00", ""))
    return page.select("key", plain_time("first_failure_time"), "total_count", "has_more")


@query("dlq_stats", with_sql("fail", "state", body=f"""
SELECT count(*) FILTER (status = 'failed') AS total_failed, count(*) FILTER (status = 'retry') AS in_retry_queue,
  count(*) FILTER (status = 'retry' AND retry_after <= {NOW_SQL}) AS ready_for_retry FROM state"""))
def dlq_stats(spark, sf_dir):
    return dlq.letter_stats(_state(spark, sf_dir), _now())


@query("dlq_by_reason", with_sql("fail", "state", body="""
SELECT failure_reason, count(*) AS n FROM state GROUP BY failure_reason"""))
def dlq_by_reason(spark, sf_dir):
    return dlq.letters_by_reason(_state(spark, sf_dir))


@query("dlq_lag", with_sql("fail", body="""
, high AS (SELECT partition, max("offset") + 1 AS high_water FROM fail GROUP BY partition),
done AS (SELECT CAST(event_id % 16 AS INTEGER) AS partition, max(event_id) + 1 AS position FROM events
  WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1)
SELECT partition, CAST(sum(high_water) AS BIGINT) AS high_water, CAST(sum(coalesce(position, 0)) AS BIGINT) AS position,
  CAST(sum(high_water - coalesce(position, 0)) AS BIGINT) AS lag
FROM high LEFT JOIN done USING (partition) GROUP BY ROLLUP (partition)"""))
def dlq_lag(spark, sf_dir):
    failures = tables.failures(spark, sf_dir)
    read = failures.filter(F.col("failed_at") < F.lit("2024-01-20").cast("timestamp"))
    committed = read.groupBy("partition").agg((F.max("offset") + 1).alias("position"))
    return dlq.queue_depth(failures, committed)


def _latest_files(spark, sf_dir):
    return led.latest_per_key(tables.ledger(spark, sf_dir), ["file"], ["timestamp", "attempt"])


@query("file_ledger", with_sql("ledger", "latest", body="""
SELECT file, status, record_count, processing_time, error, timestamp, attempt FROM latest"""))
def file_ledger(spark, sf_dir):
    return _latest_files(spark, sf_dir)


@query("latest_per_key", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type,
  max(ts) AS ts, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id""")
def latest_event(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts", "value")
    return led.latest_per_key(events, ["user_id"], ["ts", "event_id"])


_SUMMARY = """count(*) FILTER (status = 'success') AS processed_files,
  count(*) FILTER (status <> 'success') AS failed_files,
  CAST(coalesce(sum(record_count) FILTER (status = 'success'), 0) AS BIGINT) AS total_records,
  CASE WHEN failed_files > 0 AND processed_files > 0 THEN 'partial_success' WHEN failed_files > 0 THEN 'failed'
    WHEN processed_files > 0 THEN 'success' ELSE 'no_files' END AS status"""


@query("run_summary", with_sql("ledger", body=f"""
SELECT strftime(timestamp, '%Y-%m-%d') AS run, {_SUMMARY} FROM ledger GROUP BY run"""))
def run_summary(spark, sf_dir):
    runs = tables.ledger(spark, sf_dir).withColumn("run", F.date_format("timestamp", "yyyy-MM-dd"))
    return led.run_summary(runs, "run")


@query("run_summary_by_pattern", with_sql("ledger", "latest", body=f"""
SELECT CASE WHEN file LIKE '%/pending#_%.json' ESCAPE '#' THEN 'pending_*.json' WHEN file LIKE '%.jsonl' THEN '*.jsonl'
  ELSE '*.json' END AS pattern, {_SUMMARY}
FROM latest GROUP BY ROLLUP (pattern)"""))
def run_summary_by_pattern(spark, sf_dir):
    return led.run_summary_by_pattern(_latest_files(spark, sf_dir))


@query("run_metrics", with_sql("ledger", body="""
SELECT run, processed_files, processed_records, round(total_seconds, 4) AS total_seconds,
  round(total_seconds / nullif(processed_files, 0), 6) AS avg_seconds_per_file,
  round(total_seconds / nullif(processed_records, 0), 6) AS avg_seconds_per_record,
  round(processed_records / nullif(total_seconds, 0), 6) AS records_per_second
FROM (SELECT strftime(timestamp, '%Y-%m') AS run, count(*) FILTER (status = 'success') AS processed_files,
    CAST(coalesce(sum(record_count) FILTER (status = 'success'), 0) AS BIGINT) AS processed_records,
    sum(processing_time) AS total_seconds FROM ledger GROUP BY run)"""))
def run_metrics(spark, sf_dir):
    runs = tables.ledger(spark, sf_dir).withColumn("run", F.date_format("timestamp", "yyyy-MM"))
    return led.run_metrics(runs, "run").select(
        "run", "processed_files", "processed_records", rounded("total_seconds", 4),
        rounded("avg_seconds_per_file"), rounded("avg_seconds_per_record"), rounded("records_per_second"),
    )


@query("retention_prune", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-25 00:00:00'""")
def retention_prune(spark, sf_dir):
    orders = tables.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return led.keep_recent(orders, "o_orderdate", datetime(1998, 8, 1), days=7)


@query("batch_size_class", """
SELECT doc_id, n_chars, CASE WHEN n_chars < 100 THEN 'small_<100' WHEN n_chars < 500 THEN 'medium_100-500'
  WHEN n_chars < 1000 THEN 'large_500-1000' WHEN n_chars < 5000 THEN 'xlarge_1000-5000' ELSE 'xxlarge_5000+' END
  AS batch_class FROM documents""")
def batch_size_class(spark, sf_dir):
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return docs.withColumn("batch_class", labels.batch_size_class(F.col("n_chars")))


@query("throughput_class", """
SELECT event_id, CASE WHEN r >= 5000 THEN 'excellent' WHEN r >= 2000 THEN 'good' WHEN r >= 1000 THEN 'moderate'
    WHEN r >= 100 THEN 'moderate_below_target' ELSE 'low' END AS level, r >= 1000 AS on_target,
  CASE WHEN r >= 8000 THEN 'excellent' WHEN r >= 5000 THEN 'good' WHEN r >= 2000 THEN 'normal' ELSE 'low' END
    AS flush_level,
  CASE WHEN r > 1200 THEN 'target_met' WHEN r > 800 THEN 'good' ELSE 'below_target' END AS store_level
FROM (SELECT event_id, value * 20 AS r FROM events)""")
def throughput_class(spark, sf_dir):
    rate = F.col("value") * 20
    return tables.table(spark, sf_dir, "events").select(
        "event_id", labels.throughput_class(rate).alias("level"), labels.meets_target(rate).alias("on_target"),
        labels.throughput_class(rate, labels.FLUSH_BANDS).alias("flush_level"),
        labels.store_write_class(rate).alias("store_level"),
    )


@query("sla_breach", "SELECT event_id, value > 30 AS breach FROM events")
def sla_breach(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    return events.select("event_id", labels.sla_breach(F.col("value")).alias("breach"))


@query("resource_status", with_sql("res", body="SELECT service, cpu, mem, disk, status FROM res"))
def resource_status(spark, sf_dir):
    graded = metrics.with_resource_status(tables.resource_samples(spark, sf_dir))
    return graded.select(
        "service", F.col("cpu_percent").alias("cpu"), F.col("memory_percent").alias("mem"),
        F.col("disk_percent").alias("disk"), "status",
    )


@query("health_rollup", with_sql("res", body="""
SELECT service, count(*) AS n_samples, count(*) FILTER (status = 'unhealthy') AS n_unhealthy,
  count(*) FILTER (status = 'degraded') AS n_degraded,
  CASE WHEN bool_or(status = 'unhealthy') THEN 'unhealthy' WHEN bool_or(status = 'degraded') THEN 'degraded'
    WHEN bool_and(status = 'healthy') THEN 'healthy' ELSE 'unknown' END AS status
FROM res GROUP BY ROLLUP (service)"""))
def health_rollup(spark, sf_dir):
    return metrics.health_rollup(tables.resource_samples(spark, sf_dir))


_FAMILY = "SELECT '{}' AS metric, concat_ws(',', {}) AS labels, count(*) AS total FROM oplog {} GROUP BY ALL"
COUNTER_SQL = with_sql("oplog", body=" UNION ALL ".join(
    _FAMILY.format(
        metric, ", ".join(f"'{c}=' || coalesce(CAST({c} AS VARCHAR), '')" for c in names),
        f"WHERE {condition}" if condition else "",
    )
    for metric, (names, condition) in metrics.COUNTERS.items()
))


@query("counter_table", COUNTER_SQL)
def counter_table(spark, sf_dir):
    return metrics.counter_table(tables.op_log(spark, sf_dir))


@query("latency_histogram", with_sql("oplog", body="""
SELECT component, le, count(*) FILTER (duration_s <= le) AS n, count(*) AS total_count, round(sum(duration_s), 4) AS total_sum
FROM oplog, (SELECT unnest([EDGES, CAST('inf' AS DOUBLE)]) AS le) GROUP BY component, le""".replace(
    "EDGES", ", ".join(str(e) for e in HISTOGRAM_EDGES["pipeline"]))))
def latency_histogram(spark, sf_dir):
    buckets = metrics.histogram(tables.op_log(spark, sf_dir), "duration_s", ["component"])
    return buckets.select("component", "le", "n", "total_count", rounded("total_sum", 4))


@query("latency_percentiles", with_sql("oplog", body="""
SELECT component, p, round(quantile_cont(duration_s, p), 6) AS value FROM (
  SELECT component, duration_s FROM oplog), (SELECT unnest([0.5, 0.95, 0.99]) AS p) GROUP BY component, p""").replace(
    "round(quantile_cont(duration_s, p), 6)",
    "round(CASE p WHEN 0.5 THEN quantile_cont(duration_s, 0.5) WHEN 0.95 THEN quantile_cont(duration_s, 0.95) "
    "ELSE quantile_cont(duration_s, 0.99) END, 6)").replace("[0.5, 0.95, 0.99]", "[0.5::DOUBLE, 0.95, 0.99]"))
def latency_percentiles(spark, sf_dir):
    found = metrics.exact_percentiles(tables.op_log(spark, sf_dir), "duration_s", ["component"])
    return found.select("component", "p", rounded("value"))


@query("latency_percentiles_approx", with_sql("oplog", body="""
SELECT component, p, true AS within_bound FROM (SELECT DISTINCT component FROM oplog), (SELECT unnest([0.5::DOUBLE, 0.95, 0.99]) AS p)"""))
def latency_percentiles_approx(spark, sf_dir):
    """Whether the exact rank of each approximate percentile is as close as promised: a
    value's ranks are those of its first and last occurrence."""
    log, accuracy = tables.op_log(spark, sf_dir), 10_000
    found = metrics.approx_percentiles(log, "duration_s", ["component"], accuracy=accuracy)
    met = log.select("component", "duration_s").join(F.broadcast(found), "component")
    ranks = met.groupBy("component", "p").agg(
        F.count_if(F.col("duration_s") < F.col("value")).alias("below"),
        F.count_if(F.col("duration_s") <= F.col("value")).alias("upto"), F.count("*").alias("n"),
    )
    wanted, slack = F.ceil(F.col("p") * F.col("n")), F.ceil(F.col("n") / accuracy) + 1
    close = (F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)
    return ranks.select("component", "p", close.alias("within_bound"))


@query("latency_by_class", with_sql("oplog", body="""
SELECT CASE WHEN batch_size < 100 THEN 'small_<100' WHEN batch_size < 500 THEN 'medium_100-500'
  WHEN batch_size < 1000 THEN 'large_500-1000' WHEN batch_size < 5000 THEN 'xlarge_1000-5000' ELSE 'xxlarge_5000+' END
  AS batch_class, count(*) AS n, round(avg(duration_s), 6) AS avg_s, max(duration_s) AS max_s FROM oplog GROUP BY 1"""))
def latency_by_class(spark, sf_dir):
    log = tables.op_log(spark, sf_dir)
    summary = metrics.latency_by_class(log, labels.batch_size_class(F.col("batch_size")))
    return summary.select("batch_class", "n", rounded("avg_s"), "max_s")


RATES_SQL = """
WITH s AS (SELECT event_type, time_bucket(INTERVAL 10 SECOND, ts) AS step, count(*) AS n FROM events GROUP BY ALL),
x AS (SELECT event_type, step, n, step - to_seconds(10 * unnest(range(6))) AS window_start FROM s)
SELECT event_type, window_start, window_start + INTERVAL 60 SECOND AS window_end, CAST(sum(n) AS BIGINT) AS n_60s,
  CAST(coalesce(sum(n) FILTER (step = window_start + INTERVAL 50 SECOND), 0) AS BIGINT) AS n_10s,
  round(n_60s / 60, 6) AS rate_60s, round(n_10s / 10, 6) AS rate_10s,
  CASE WHEN n_60s / 60 >= 5000 THEN 'excellent' WHEN n_60s / 60 >= 2000 THEN 'good' WHEN n_60s / 60 >= 1000 THEN 'moderate'
    WHEN n_60s / 60 >= 100 THEN 'moderate_below_target' ELSE 'low' END AS level, n_60s / 60 >= 1000 AS on_target
FROM x GROUP BY event_type, window_start"""


def rate_columns(rates):
    return rates.select(
        "event_type", plain_time("window_start"), plain_time("window_end"), "n_60s", "n_10s",
        rounded("rate_60s"), rounded("rate_10s"), "level", "on_target",
    )


@query("rate_sliding", RATES_SQL)
def rate_sliding(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return rate_columns(metrics.sliding_rates(events, "ts", ["event_type"]))


@query("rates_at", f"""
SELECT count(*) FILTER (age >= 0) AS n_total, round(count(*) FILTER (age BETWEEN 0 AND 60) / 60, 6) AS rate_60s,
  round(count(*) FILTER (age BETWEEN 0 AND 10) / 10, 6) AS rate_10s,
  round(count(*) FILTER (age >= 0) / max(age), 6) AS rate_overall
FROM (SELECT epoch_us({NOW_SQL} - ts) / 1e6 AS age FROM events)""")
def rates_at(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    rates = metrics.rates_at(events, "ts", _now())
    return rates.select("n_total", rounded("rate_60s"), rounded("rate_10s"), rounded("rate_overall"))


@query("counter_rate", """
WITH s AS (
  SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, value,
    lag(value) OVER (PARTITION BY event_type ORDER BY ts, value) AS before
  FROM events)
SELECT event_type, window_start, count(*) AS n_samples,
  round(sum(CASE WHEN before IS NULL THEN 0 WHEN value >= before THEN value - before ELSE value END), 6) AS increase,
  round(sum(CASE WHEN before IS NULL THEN 0 WHEN value >= before THEN value - before ELSE value END) / 300, 6) AS rate
FROM s GROUP BY event_type, window_start""")
def counter_rate(spark, sf_dir):
    samples = tables.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    rates = metrics.counter_rates(samples, "ts", "value", ["event_type"])
    return rates.select("event_type", plain_time("window_start"), "n_samples", rounded("increase"), rounded("rate"))
