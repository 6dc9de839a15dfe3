"""The given tables in the shapes the operators take, with the same shapes in SQL.

Each frame here has a twin text in ``SQL`` for the DuckDB check. Optional fields are
filled by rules on the event id, so NULL, '' and absent values all occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.operators.deadletters import message_key
from eddyline.schemas import FAILURE_REASONS
from eddyline.session import spread, tasks_for

# Fixed values.
TOPIC = "ecommerce-events"
PAYMENT_METHODS = ("credit_card", "debit_card", "paypal", "bank_transfer", "cash_on_delivery")
PARTITIONS = 16
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Timestamps of the tables carry no zone; UTC keeps them as written.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """For queries whose cost is in expressions rather than in the scan."""
    return spread(table(spark, sf_dir, name))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.pmod("p_size", F.lit(10))
    description = F.when(size == 0, F.lit("")).when(
        size != 1, F.concat_ws(" ", "p_brand", "p_type", "p_name")
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.struct(
            F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
            description.alias("description"), F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("price"),
        ).alias("product"),
    )


def as_events(raw: DataFrame, spark: SparkSession, sf_dir: str, tasks: int) -> DataFrame:
    """Rows of the events table (batch or stream) as behaviour events, keeping ``eid, ts``.

    The join key is spread evenly, so neither side has a hot key. The catalogue grows with
    the events: it is shuffled with them and never goes through the driver, which every
    epoch of a stream would repeat. What is joined is dealt to ``tasks``.
    """
    n_products = table(spark, sf_dir, "part").count()
    eid, kind = F.col("event_id"), F.col("event_type")
    keyed = raw.withColumn("p_partkey", F.pmod(eid, F.lit(n_products)))
    joined = keyed.join(products(spark, sf_dir).hint("merge"), "p_partkey").repartition(tasks, "event_id")
    without_product = (kind == "signup") & (F.pmod(eid, F.lit(5)) == 0)
    bought, seen, third = kind == "purchase", kind == "view", F.pmod(eid, F.lit(3))
    quantity = F.when(bought, (third + 1).cast("int"))
    methods = F.array(*[F.lit(m) for m in PAYMENT_METHODS])
    user = F.concat(F.lit("user"), F.col("user_id"))
    return joined.select(
        eid.alias("eid"), F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("uid"), "value",
        eid.cast("string").alias("event_id"),
        F.date_format("ts", ISO).alias("timestamp"),
        user.alias("user_id"), "event_type",
        F.when(~without_product, F.col("product")).alias("product"),
        F.concat(user, F.lit("-"), F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
        F.when(seen & (third == 0), F.concat(F.lit("find "), F.col("product.name")))
        .when(seen & (third == 1), F.lit("")).alias("search_query"),
        F.when(seen & (third == 0), F.pmod(eid, F.lit(40)).cast("int")).alias("results_count"),
        quantity.alias("quantity"),
        (F.col("product.price") * quantity).alias("total_amount"),
        F.when(bought, F.element_at(methods, (F.pmod(eid, F.lit(5)) + 1).cast("int"))).alias("payment_method"),
        F.when(seen, (F.pmod(eid, F.lit(296)) + 5).cast("int")).alias("view_duration"),
    )


EVENT_COLUMNS = (
    "event_id", "timestamp", "user_id", "event_type", "product", "session_id", "search_query",
    "results_count", "quantity", "total_amount", "payment_method", "view_duration",
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return as_events(rows, spark, sf_dir, tasks_for(rows.count(), spark))


def as_raw(event_rows: DataFrame) -> DataFrame:
    """Kafka-shaped records: the event as JSON, every 50th value cut by one character."""
    value = F.to_json(F.struct(*EVENT_COLUMNS))
    cut = F.pmod("eid", F.lit(50)) == 0
    value = F.when(cut, F.substr(value, F.lit(1), F.length(value) - 1)).otherwise(value)
    return event_rows.select(
        F.col("user_id").cast("binary").alias("key"), value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"), F.pmod("eid", F.lit(PARTITIONS)).cast("int").alias("partition"),
        F.col("eid").alias("offset"), F.col("ts").alias("timestamp"),
    )


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw(events(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"), "doc_id", "lang", "source"
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as messages; every tenth has no metadata, every seventh empty content."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), doc).alias("id"),
        F.when(F.pmod(doc, F.lit(7)) == 0, F.lit("")).otherwise(F.col("text")).alias("content"),
        F.lit("2024-01-01T00:00:00Z").alias("timestamp"),
        F.when(F.pmod(doc, F.lit(10)) != 0, F.create_map(F.lit("source"), F.col("source"))).alias("metadata"),
    )


def _user_week() -> Column:
    week = F.floor((F.dayofmonth("ts") - 1) / 7)
    return F.concat(F.lit("user"), F.col("user_id"), F.lit("-w"), week)


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events as a failure log. A user's week stands for the message that keeps
    failing; every ninth record has no message id and is known by its coordinates."""
    return as_failures(table(spark, sf_dir, "events"))


def as_failures(event_rows: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    reasons = F.array(*[F.lit(r) for r in FAILURE_REASONS])
    log = event_rows.filter(F.col("event_type") == "error").select(
        F.when(F.pmod(eid, F.lit(9)) != 0, _user_week()).alias("id"), F.lit(TOPIC).alias("topic"),
        F.pmod(eid, F.lit(PARTITIONS)).cast("int").alias("partition"), eid.alias("offset"),
        F.col("props").alias("value"),
        F.element_at(reasons, (F.pmod(eid, F.lit(8)) + 1).cast("int")).alias("failure_reason"),
        F.concat(F.lit("error at "), eid).alias("error_message"),
        F.col("ts").cast("timestamp").alias("failed_at"),
    )
    return log.withColumn("key", message_key()).drop("id")


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_outcomes(table(spark, sf_dir, "events"))


def as_outcomes(event_rows: DataFrame) -> DataFrame:
    """Signup events as retry results of the same users."""
    eid = F.col("event_id")
    return event_rows.filter(F.col("event_type") == "signup").select(
        _user_week().alias("key"), F.lit(TOPIC).alias("topic"),
        F.pmod(eid, F.lit(PARTITIONS)).cast("int").alias("partition"), eid.alias("offset"),
        F.col("props").alias("value"), F.lit("timeout_error").alias("failure_reason"),
        F.lit(None).cast("string").alias("error_message"),
        F.col("ts").cast("timestamp").alias("finished_at"),
        (F.pmod(eid, F.lit(4)) == 0).alias("succeeded"), (F.pmod(eid, F.lit(4)) == 1).alias("raised"),
    )


def as_op_log(event_rows: DataFrame) -> DataFrame:
    """Event rows as finished operations."""
    eid = F.col("event_id")
    status = F.when(F.pmod(eid, F.lit(20)) == 0, F.lit("error")).otherwise(F.lit("success"))
    return event_rows.select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("component"),
        F.when(F.pmod(eid, F.lit(2)) == 0, F.lit("write")).alias("operation"),
        F.lit("embeddings").alias("collection"), F.lit(TOPIC).alias("topic"),
        F.pmod(eid, F.lit(PARTITIONS)).cast("int").alias("partition"), status.alias("status"),
        F.when(F.pmod(eid, F.lit(20)) == 0, F.concat(F.lit("code_"), F.pmod(eid, F.lit(3)))).alias("error_type"),
        F.when(F.pmod(eid, F.lit(2)) == 1, F.lit("hash")).alias("model"),
        F.pmod(eid * 37, F.lit(6000)).cast("int").alias("batch_size"),
        F.col("value").alias("duration_s"),
    )


def op_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_op_log(table(spark, sf_dir, "events"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as file results: one file per customer, one attempt per order."""
    customer, status = F.col("o_custkey"), F.col("o_orderstatus")
    name = F.when(F.pmod(customer, F.lit(3)) == 0, F.concat(F.lit("pending_"), customer, F.lit(".json"))).when(
        F.pmod(customer, F.lit(3)) == 1, F.concat(F.lit("batch_"), customer, F.lit(".jsonl"))
    ).otherwise(F.concat(F.lit("batch_"), customer, F.lit(".json")))
    ok = status == "O"
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("/input/"), name).alias("file"),
        F.when(ok, F.lit("success")).when(status == "P", F.lit("empty")).otherwise(F.lit("error")).alias("status"),
        F.when(ok, F.pmod("o_orderkey", F.lit(500)) + 1).otherwise(F.lit(0)).cast("bigint").alias("record_count"),
        F.when(ok, F.col("o_totalprice") / 1000).otherwise(F.lit(0.0)).alias("processing_time"),
        F.when(status == "F", F.lit("read failed")).alias("error"),
        F.col("o_orderdate").alias("timestamp"), F.col("o_orderkey").alias("attempt"),
    )


def resource_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("service"), F.col("value").alias("cpu_percent"),
        F.pmod("event_id", F.lit(100)).cast("double").alias("memory_percent"), used.alias("disk_percent"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label"
    )


# The same shapes for DuckDB; a query's SQL starts with the ones it needs.
SQL = {
    "ev": """ev AS (
  SELECT e.event_id AS eid, e.ts AS ts, e.value AS value, CAST(e.event_id AS VARCHAR) AS event_id,
    strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp,
    'user' || e.user_id AS user_id, e.event_type AS event_type,
    NOT (e.event_type = 'signup' AND e.event_id % 5 = 0) AS has_product,
    CASE WHEN has_product THEN CAST(p_partkey AS VARCHAR) END AS product_id,
    CASE WHEN has_product THEN p_name END AS product_name,
    CASE WHEN NOT has_product OR p_size % 10 = 1 THEN NULL WHEN p_size % 10 = 0 THEN ''
         ELSE p_brand || ' ' || p_type || ' ' || p_name END AS product_description,
    CASE WHEN has_product THEN p_type END AS product_category,
    CASE WHEN has_product THEN p_retailprice END AS product_price,
    'user' || e.user_id || '-' || strftime(e.ts, '%Y-%m-%d') AS session_id,
    CASE WHEN e.event_type = 'view' AND e.event_id % 3 = 0 THEN 'find ' || p_name
         WHEN e.event_type = 'view' AND e.event_id % 3 = 1 THEN '' END AS search_query,
    CASE WHEN e.event_type = 'view' AND e.event_id % 3 = 0 THEN CAST(e.event_id % 40 AS INTEGER) END AS results_count,
    CASE WHEN e.event_type = 'purchase' THEN CAST(e.event_id % 3 + 1 AS INTEGER) END AS quantity,
    CASE WHEN e.event_type = 'purchase' THEN p_retailprice * (e.event_id % 3 + 1) END AS total_amount,
    CASE WHEN e.event_type = 'purchase' THEN
      ['credit_card','debit_card','paypal','bank_transfer','cash_on_delivery'][e.event_id % 5 + 1] END AS payment_method,
    CASE WHEN e.event_type = 'view' THEN CAST(e.event_id % 296 + 5 AS INTEGER) END AS view_duration
  FROM events e JOIN part ON p_partkey = e.event_id % (SELECT count(*) FROM part))""",
    "fail": """fail AS (
  SELECT CASE WHEN event_id % 9 = 0 THEN 'ecommerce-events|' || (event_id % 16) || '|' || event_id
      ELSE 'user' || user_id || '-w' || ((day(ts) - 1) // 7) END AS key, CAST(event_id % 16 AS INTEGER) AS partition, event_id AS "offset", props AS value,
    ['parse_error','processing_error','embedding_error','store_error','timeout_error','validation_error',
     'circuit_breaker_open','unknown_error'][event_id % 8 + 1] AS failure_reason,
    'error at ' || event_id AS error_message, ts AS failed_at
  FROM events WHERE event_type = 'error')""",
    "outc": """outc AS (
  SELECT 'user' || user_id || '-w' || ((day(ts) - 1) // 7) AS key, ts AS finished_at, event_id AS "offset",
    event_id % 4 = 0 AS succeeded, event_id % 4 = 1 AS raised
  FROM events WHERE event_type = 'signup')""",
    "state": """state AS (
  SELECT key, count(*) AS attempt_count, min(failed_at) AS first_failure_time, max(failed_at) AS last_failure_time,
    arg_min(failure_reason, (failed_at, "offset")) AS failure_reason,
    arg_max(error_message, (failed_at, "offset")) AS error_details,
    arg_min("offset", (failed_at, "offset")) AS "offset",
    CASE WHEN count(*) >= 3 THEN 'failed' ELSE 'retry' END AS status,
    CASE WHEN count(*) < 3 THEN date_trunc('second', max(failed_at))
      + to_seconds([60, 300, 900][least(count(*), 3)]) END AS retry_after
  FROM fail GROUP BY key)""",
    "oplog": """oplog AS (
  SELECT ts, event_type AS component, CASE WHEN event_id % 2 = 0 THEN 'write' END AS operation,
    'embeddings' AS collection, 'ecommerce-events' AS topic, event_id % 16 AS partition,
    CASE WHEN event_id % 20 = 0 THEN 'error' ELSE 'success' END AS status,
    CASE WHEN event_id % 20 = 0 THEN 'code_' || (event_id % 3) END AS error_type,
    CASE WHEN event_id % 2 = 1 THEN 'hash' END AS model,
    CAST(event_id * 37 % 6000 AS INTEGER) AS batch_size, value AS duration_s
  FROM events)""",
    "ledger": """ledger AS (
  SELECT '/input/' || CASE o_custkey % 3 WHEN 0 THEN 'pending_' || o_custkey || '.json'
      WHEN 1 THEN 'batch_' || o_custkey || '.jsonl' ELSE 'batch_' || o_custkey || '.json' END AS file,
    CASE o_orderstatus WHEN 'O' THEN 'success' WHEN 'P' THEN 'empty' ELSE 'error' END AS status,
    CASE WHEN o_orderstatus = 'O' THEN o_orderkey % 500 + 1 ELSE 0 END AS record_count,
    CASE WHEN o_orderstatus = 'O' THEN o_totalprice / 1000 ELSE 0.0 END AS processing_time,
    CASE WHEN o_orderstatus = 'F' THEN 'read failed' END AS error,
    o_orderdate AS timestamp, o_orderkey AS attempt
  FROM orders)""",
    "latest": """latest AS (
  SELECT * FROM ledger QUALIFY row_number() OVER (PARTITION BY file ORDER BY timestamp DESC, attempt DESC) = 1)""",
    "res": """res AS (
  SELECT event_type AS service, value AS cpu, CAST(event_id % 100 AS DOUBLE) AS mem,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS disk,
    CASE WHEN greatest(cpu, mem, disk) > 95 THEN 'unhealthy' WHEN greatest(cpu, mem, disk) > 85 THEN 'degraded'
         ELSE 'healthy' END AS status FROM events)""",
}


def with_sql(*names: str, body: str) -> str:
    return "WITH " + ",\n".join(SQL[n] for n in names) + "\n" + body


def hash_vector_sql(text: str) -> str:
    """Twin of ``hash_vector_columns``: the 384 cells are made, then described."""
    cells = (
        f"list_transform(range(384), lambda i: CASE WHEN {text} IS NULL OR {text} = '' THEN 0 ELSE "
        f"CAST(('0x' || substr(md5({text}), CAST(i % 16 * 2 + 1 AS INTEGER), 2)) AS INTEGER) END)"
    )
    return (
        f"CAST(len({cells}) AS INTEGER) AS width, array_to_string({cells}[1:16], ',') AS cells, "
        f"list_sum({cells}) = 24 * list_sum({cells}[1:16]) AS repeats"
    )
