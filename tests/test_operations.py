import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from eddyline.functions import labels
from eddyline.operators import deadletters as dlq
from eddyline.operators import ledger as led
from eddyline.operators import metrics

T0 = datetime(2024, 1, 15, 10, 0, 0, 250000)
LOG = """key string, topic string, partition int, offset long, value string, failure_reason string,
 error_message string, failed_at timestamp"""


def failures(spark, *rows):
    """(key, minutes, reason) rows."""
    full = [(k, "t", 0, i, "{}", reason, f"e{i}", T0 + timedelta(minutes=m)) for i, (k, m, reason) in enumerate(rows)]
    return spark.createDataFrame(full, LOG)


def state(df):
    return {r.key: r for r in df.collect()}


def test_attempts_schedule_and_permanent_failure(spark):
    log = failures(
        spark, ("a", 0, "timeout_error"), ("b", 0, "parse_error"), ("b", 5, "store_error"),
        ("c", 0, "parse_error"), ("c", 1, "parse_error"), ("c", 2, "parse_error"),
    )
    got = state(dlq.fold_failures(log))
    second = T0.replace(microsecond=0)
    assert (got["a"].status, got["a"].attempt_count) == ("retry", 1)
    assert got["a"].retry_after == second + timedelta(seconds=60)
    assert got["b"].retry_after == second + timedelta(minutes=5, seconds=300)
    assert (got["b"].failure_reason, got["b"].error_details) == ("parse_error", "e2")
    assert (got["c"].status, got["c"].retry_after) == ("failed", None)


def test_one_allowed_attempt_fails_at_once_and_late_attempts_reuse_the_last_delay(spark):
    log = failures(spark, *[("a", m, "parse_error") for m in range(5)])
    assert state(dlq.fold_failures(log, max_retries=1))["a"].status == "failed"
    late = state(dlq.fold_failures(log, max_retries=9))["a"]
    assert late.retry_after == T0.replace(microsecond=0) + timedelta(minutes=4, seconds=900)


def test_due_exactly_now(spark):
    folded = dlq.fold_failures(failures(spark, ("a", 0, "parse_error"), ("b", 1, "parse_error")))
    now = F.lit("2024-01-15 10:01:00").cast("timestamp")
    assert [r.key for r in dlq.due_retries(folded, now).collect()] == ["a"]


def test_every_third_of_six_messages_fails_twice(spark):
    log = failures(spark, ("m2", 0, "processing_error"), ("m5", 0, "processing_error"))
    folded = dlq.fold_failures(log, max_retries=2)
    assert {r.status for r in folded.collect()} == {"retry"}
    again = log.unionAll(failures(spark, ("m2", 9, "processing_error"), ("m5", 9, "processing_error")))
    stats = dlq.letter_stats(dlq.fold_failures(again, max_retries=2), F.current_timestamp()).first()
    assert (stats.total_failed, stats.in_retry_queue) == (2, 0)


def test_outcomes(spark):
    log = failures(spark, ("ok", 0, "parse_error"), ("again", 0, "parse_error"), ("raised", 0, "parse_error"),
                   ("back", 0, "parse_error"), ("back", 1, "parse_error"), ("back", 30, "timeout_error"))
    schema = LOG.replace("failed_at", "finished_at") + ", succeeded boolean, raised boolean"
    at = T0 + timedelta(minutes=10)
    made = lambda key, good, raised: (key, "t", 0, 99, "{}", "parse_error", None, at, good, raised)
    outcomes = spark.createDataFrame(
        [made("ok", True, False), made("again", False, False), made("raised", False, True), made("back", True, False)], schema
    )
    got = state(dlq.fold_with_outcomes(log, outcomes))
    assert set(got) == {"again", "raised", "back"}
    assert got["again"].attempt_count == 2 and got["again"].error_details == "Retry failed"
    assert got["raised"].failure_reason == "parse_error"
    assert (got["back"].attempt_count, got["back"].failure_reason) == (1, "timeout_error")


def test_filter_and_unknown_reason(spark):
    folded = dlq.fold_failures(failures(spark, ("a", 0, "parse_error"), ("b", 0, "timeout_error")))
    assert [r.key for r in dlq.filter_letters(folded, key="a", reason="parse_error").collect()] == ["a"]
    assert dlq.filter_letters(folded, key="a", reason="timeout_error").count() == 0
    with pytest.raises(ValueError):
        dlq.filter_letters(folded, reason="no_such_reason")


def test_pages_follow_each_other(spark):
    folded = dlq.fold_failures(failures(spark, *[(f"k{i}", i // 2, "parse_error") for i in range(7)]))
    seen, after = [], None
    while True:
        rows = dlq.letter_page(folded, 3, after).collect()
        seen += [r.key for r in rows]
        assert {r.total_count for r in rows} == {7}
        if not rows[-1].has_more:
            break
        after = (rows[-1].first_failure_time, rows[-1].key)
    assert seen == [f"k{i}" for i in range(7)]


def test_replay_replaces_old_headers(spark):
    log = failures(spark, ("a", 0, "parse_error"))
    letters = dlq.dead_letter_rows(log, F.lit("parse_error"), F.lit("e"), F.col("failed_at"))
    now = F.lit("2024-01-20").cast("timestamp")
    first = dlq.replay_records(letters, now).first()
    assert first.topic == "t" and first.headers["original_failure_reason"] == "parse_error"
    again = letters.withColumn("original_headers", F.create_map(F.lit("dlq_replay"), F.lit("old"), F.lit("x"), F.lit("y")))
    headers = dlq.replay_records(again, now, "other").first().headers
    assert headers["dlq_replay"] == "true" and headers["x"] == "y"


def test_unknown_reasons_are_named_so(spark):
    letters = dlq.dead_letter_rows(failures(spark, ("a", 0, "odd")), F.col("failure_reason"), F.lit("e"), F.col("failed_at"))
    assert letters.first().failure_reason == "unknown_error"


def test_messages_without_id_do_not_match_each_other(spark):
    rows = [(None, "t", 0, 1), (None, "t", 0, 2), ("m", "t", 0, 3)]
    df = spark.createDataFrame(rows, "id string, topic string, partition int, offset long")
    assert [r[0] for r in df.select(dlq.message_key()).collect()] == ["t|0|1", "t|0|2", "m"]


def test_run_summary_statuses(spark):
    rows = [("a", "success", 5), ("b", "success", 2), ("b", "empty", 0), ("c", "error", 0)]
    df = spark.createDataFrame(rows, "run string, status string, record_count long")
    got = {r.run: (r.status, r.processed_files, r.failed_files, r.total_records) for r in led.run_summary(df, "run").collect()}
    assert got == {"a": ("success", 1, 0, 5), "b": ("partial_success", 1, 1, 2), "c": ("failed", 0, 1, 0)}
    assert led.run_summary(df.limit(0)).first().status == "no_files"


def test_run_metrics_without_work(spark):
    df = spark.createDataFrame([("error", 0, 0.0)], "status string, record_count long, processing_time double")
    row = led.run_metrics(df).first()
    assert (row.avg_seconds_per_file, row.records_per_second) == (None, None)


def test_retention_keeps_the_cutoff_itself(spark):
    now = datetime(2024, 1, 10)
    rows = [(now - timedelta(days=7),), (now - timedelta(days=7, microseconds=1),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    assert led.keep_recent(df, "t", now).count() == 1


def test_class_edges(spark):
    df = spark.createDataFrame([(v,) for v in (99, 100, 499, 500, 999, 1000, 4999, 5000, None)], "v int")
    got = [r[0] for r in df.select(labels.batch_size_class(F.col("v"))).collect()]
    assert got == ["small_<100", "medium_100-500", "medium_100-500", "large_500-1000", "large_500-1000",
                   "xlarge_1000-5000", "xlarge_1000-5000", "xxlarge_5000+", None]
    rates = spark.createDataFrame([(800.0,), (800.1,), (1200.0,), (1200.1,)], "v double")
    assert [r[0] for r in rates.select(labels.store_write_class(F.col("v"))).collect()] == [
        "below_target", "good", "good", "target_met"]


def samples(spark, *rows):
    return spark.createDataFrame(rows, "service string, cpu_percent double, memory_percent double, disk_percent double")


def test_health_thresholds_are_strict(spark):
    df = samples(spark, ("a", 85.0, 1.0, 1.0), ("b", 85.1, 1.0, 1.0), ("c", 1.0, 95.0, 1.0), ("d", 1.0, 1.0, 95.1), ("e", None, 1.0, 1.0))
    got = {r.service: r.status for r in metrics.health_rollup(df).collect()}
    assert got == {"a": "healthy", "b": "degraded", "c": "degraded", "d": "unhealthy", "e": "unknown", None: "unhealthy"}


@pytest.mark.parametrize("splits", [2, 64])
def test_exact_percentiles_against_numpy(spark, splits):
    rng = np.random.default_rng(1)
    groups = {
        "hot": rng.exponential(10, 5000), "ties": np.repeat([1.0, 2.0, 3.0], 400), "one": np.array([5.0]),
        "two": np.array([1.0, 9.0]), "integers": rng.integers(0, 4, 900).astype(float),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    p = (0.0, 0.5, 0.95, 0.99, 1.0)
    got = {(r.g, r.p): r.value for r in metrics.exact_percentiles(df, "v", ["g"], p, splits).collect()}
    assert len(got) == len(groups) * len(p)
    for g, values in groups.items():
        for q in p:
            assert got[(g, q)] == pytest.approx(np.quantile(values, q))


@pytest.mark.parametrize("most", [20, 300])
def test_percentiles_of_one_range_with_nearly_all_values(spark, most):
    """Distinct values close together, far from a few others: the range is cut again."""
    rng = np.random.default_rng(2)
    groups = {
        "dense": np.concatenate([1e6 + rng.uniform(0, 1e-3, 4000), [0.0, 1e9, -5.0, 7.0]]), "other": rng.normal(0, 1, 700),
        None: np.array([1.0, 2.0]), "same": np.full(900, 3.0), "inf": np.array([1.0, math.inf, math.inf]),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    p = (0.0, 0.37, 0.5, 0.99, 1.0)
    got = {(r.g, r.p): r.value for r in metrics.exact_percentiles(df, "v", ["g"], p, splits=4, most=most).collect()}
    assert len(got) == len(groups) * len(p)
    for g, values in groups.items():
        for q in p:
            if g != "inf":
                assert got[(g, q)] == pytest.approx(np.quantile(values, q), rel=1e-15, abs=1e-12)
    assert got[("inf", 0.5)] == math.inf and got[("inf", 0.0)] == 1.0


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([("a", 0.001), ("a", 0.02), ("a", 99.0), ("a", None)], "g string, v double")
    rows = {r.le: r for r in metrics.histogram(df, "v", ["g"]).collect()}
    assert rows[0.001].n == 1 and rows[0.025].n == 2 and rows[30.0].n == 2 and rows[float("inf")].n == 3
    assert rows[1.0].total_count == 3


def test_counter_reset(spark):
    rows = [("a", T0 + timedelta(seconds=i), v) for i, v in enumerate([5.0, 8.0, 2.0, 4.0])]
    df = spark.createDataFrame(rows, "g string, t timestamp, v double")
    row = metrics.counter_rates(df, "t", "v", ["g"]).first()
    assert (row.n_samples, row.increase, row.rate) == (4, 7.0, 7.0 / 300)


def test_sliding_rates(spark):
    rows = [(T0 + timedelta(seconds=s),) for s in (0, 1, 30, 59)]
    df = spark.createDataFrame(rows, "t timestamp")
    got = {r.window_end: r for r in metrics.sliding_rates(df, "t", []).collect()}
    row = got[datetime(2024, 1, 15, 10, 1, 0)]
    assert (row.n_60s, row.n_10s, row.rate_60s, row.level) == (4, 1, 4 / 60, "low")


def test_rates_at_an_instant(spark):
    now = datetime(2024, 1, 15, 12)
    ages = (0, 5, 10, 11, 60, 61, 299, 301, -1)
    df = spark.createDataFrame([(now - timedelta(seconds=a),) for a in ages], "t timestamp")
    row = metrics.rates_at(df, "t", F.lit("2024-01-15 12:00:00").cast("timestamp")).first()
    assert (row.n_total, row.rate_60s, row.rate_10s) == (8, 5 / 60, 3 / 10)
    assert row.rate_overall == pytest.approx(8 / 301)


def test_approx_percentiles(spark):
    df = spark.range(1001).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("v"))
    got = {r.p: r.value for r in metrics.approx_percentiles(df, "v", ["g"]).collect()}
    assert got == {0.5: 500.0, 0.95: 950.0, 0.99: 990.0}
