"""The file ledger: results of batch runs, their summaries, and retention."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key. Many versions of one key collapse before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("row")
    picked = df.groupBy(*keys).agg(newest)
    return picked.select(*[c if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns])


def file_pattern() -> Column:
    """The input pattern a file belongs to, the most specific one first."""
    name = F.element_at(F.split("file", "/"), -1)
    return (
        F.when(name.startswith("pending_") & name.endswith(".json"), F.lit("pending_*.json"))
        .when(name.endswith(".jsonl"), F.lit("*.jsonl"))
        .when(name.endswith(".json"), F.lit("*.json"))
    )


def _counts() -> list[Column]:
    ok = F.col("status") == "success"
    return [
        F.count_if(ok).alias("processed_files"),
        F.count_if(~ok).alias("failed_files"),
        F.coalesce(F.sum(F.when(ok, F.col("record_count"))), F.lit(0)).alias("total_records"),
    ]


def _run_status() -> Column:
    ran, failed = F.col("processed_files") > 0, F.col("failed_files") > 0
    return (
        F.when(failed & ran, F.lit("partial_success"))
        .when(failed, F.lit("failed"))
        .when(ran, F.lit("success"))
        .otherwise(F.lit("no_files"))
    )


def run_summary(ledger: DataFrame, *by: str) -> DataFrame:
    """Files and records per run; anything but ``success`` (also ``empty``) counts as failed."""
    return ledger.groupBy(*by).agg(*_counts()).withColumn("status", _run_status())


def run_summary_by_pattern(ledger: DataFrame) -> DataFrame:
    """Per input pattern, and the total in a NULL-pattern row."""
    counted = ledger.groupBy(file_pattern().alias("pattern")).agg(*_counts())
    sums = [F.sum(c).alias(c) for c in counted.columns if c != "pattern"]
    return counted.rollup("pattern").agg(*sums).withColumn("status", _run_status())


def run_metrics(ledger: DataFrame, *by: str) -> DataFrame:
    """Seconds per file and per record, and records per second; NULL when nothing ran."""
    ok = F.col("status") == "success"
    totals = ledger.groupBy(*by).agg(
        F.count_if(ok).alias("processed_files"),
        F.coalesce(F.sum(F.when(ok, F.col("record_count"))), F.lit(0)).alias("processed_records"),
        F.sum("processing_time").alias("total_seconds"),
    )
    return (
        totals.withColumn("avg_seconds_per_file", F.try_divide("total_seconds", "processed_files"))
        .withColumn("avg_seconds_per_record", F.try_divide("total_seconds", "processed_records"))
        .withColumn("records_per_second", F.try_divide("processed_records", "total_seconds"))
    )


def keep_recent(df: DataFrame, time_column: str, now: datetime, days: int = 7) -> DataFrame:
    """Retention: rows not older than ``days``. A constant bound, so scans can skip on it."""
    kind = df.schema[time_column].dataType.simpleString()
    cutoff = F.lit((now - timedelta(days=days)).strftime("%Y-%m-%d %H:%M:%S.%f")).cast(kind)
    return df.filter(F.col(time_column) >= cutoff)
