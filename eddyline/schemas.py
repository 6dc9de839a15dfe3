"""Record shapes and the constants that go with them."""

from pyspark.sql import types as T

PRODUCT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
])

EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product", PRODUCT),
    T.StructField("session_id", T.StringType()),
    T.StructField("search_query", T.StringType()),
    T.StructField("results_count", T.IntegerType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("view_duration", T.IntegerType()),
])

MESSAGE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

DOCUMENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

# Columns of the Kafka source, which file sources reproduce in tests.
KAFKA_ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

DEAD_LETTER = T.StructType([
    T.StructField("original_topic", T.StringType()),
    T.StructField("original_partition", T.IntegerType()),
    T.StructField("original_offset", T.LongType()),
    T.StructField("original_key", T.StringType()),
    T.StructField("original_value", T.StringType()),
    T.StructField("failure_reason", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("failed_at", T.TimestampType()),
    T.StructField("retry_count", T.IntegerType()),
    T.StructField("original_headers", T.MapType(T.StringType(), T.StringType())),
])

DLQ_STATE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("original_message", T.StringType()),
    T.StructField("failure_reason", T.StringType()),
    T.StructField("error_details", T.StringType()),
    T.StructField("attempt_count", T.LongType()),
    T.StructField("first_failure_time", T.TimestampType()),
    T.StructField("last_failure_time", T.TimestampType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("retry_after", T.TimestampType()),
    T.StructField("status", T.StringType()),
])

FILE_LEDGER = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("processing_time", T.DoubleType()),
    T.StructField("output_file", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

# How times are written in JSON: to the microsecond, with their zone.
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# Names and limits that results must agree on.
FAILURE_REASONS = (
    "parse_error", "processing_error", "embedding_error", "store_error",
    "timeout_error", "validation_error", "circuit_breaker_open", "unknown_error",
)
VECTOR_WIDTH = 384
MAX_CONTENT_CHARS = 32768
MIN_CONTENT_CHARS = 10
MAX_RETRIES = 3
RETRY_DELAYS_SECONDS = (60, 300, 900)

SLA_SECONDS = 30.0
INPUT_PATTERNS = ("*.json", "*.jsonl", "pending_*.json")

# Upper edges of the duration histograms, in seconds.
HISTOGRAM_EDGES = {
    "json_parse": (0.0001, 0.0005, 0.001, 0.005, 0.01, 0.05, 0.1),
    "message_processing": (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0),
    "store_operation": (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0),
    "store_commit": (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0),
    "embedding": (0.0001, 0.0005, 0.001, 0.005, 0.01, 0.025, 0.05, 0.1),
    "component": (0.0001, 0.001, 0.005, 0.01, 0.025, 0.05, 0.1),
    "pipeline": (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0),
    "health_check": (0.001, 0.005, 0.01, 0.025, 0.05, 0.1),
}
