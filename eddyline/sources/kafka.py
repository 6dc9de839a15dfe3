"""Kafka source and sink options. The connector package must be on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.schemas import JSON_TIME


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    group_id: str | None = None,
    **extra: str,
) -> dict[str, str]:
    """Lost offsets fail the query unless the caller says otherwise. A first run over a long
    topic should pass ``max_offsets_per_trigger``, sized to the cluster."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if group_id:
        options["kafka.group.id"] = group_id
    return options | extra


def read_kafka(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **kwargs)).load()


def dead_letter_records(dead_letters: DataFrame, topic: str = "dead-letter-queue") -> DataFrame:
    """(topic, key, value) rows for the Kafka sink; the value is the whole letter as JSON."""
    return dead_letters.select(
        F.lit(topic).alias("topic"),
        F.col("original_key").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in dead_letters.columns]), {"timestampFormat": JSON_TIME}).alias("value"),
    )
