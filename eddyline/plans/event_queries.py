"""Queries over behaviour events: parsing, texts, payloads, points."""

from __future__ import annotations

from pyspark.sql import functions as F

from eddyline.functions.text import TEXT_PRESETS, pipeline_text
from eddyline.functions.vectors import hash_vector
from eddyline.operators import events as ops
from eddyline.operators.metrics import event_type_summary
from eddyline.plans import tables
from eddyline.plans.catalog import hash_vector_columns, plain_time, query, rounded
from eddyline.plans.tables import hash_vector_sql, with_sql

STREAM_SQL = (
    "concat_ws(' ', event_type, product_name, product_description, product_category, search_query)"
)
_present = "concat_ws(' ', {})".format
_some = lambda *fields: _present(", ".join(f"nullif({f}, '')" for f in fields))
_TEXT_SQL = {
    "stream": STREAM_SQL,
    "partition": "trim(event_type || ' ' || coalesce(product_name, '') || ' ' || "
    "coalesce(product_description, '') || ' ' || coalesce(product_category, ''))",
    "pipeline": "CASE WHEN {0} = '' THEN 'event_' || event_id ELSE {0} END".format(
        _some("product_name", "product_description", "product_category", "search_query", "event_type")
    ),
    "task": "CASE WHEN {0} = '' THEN 'event_' || event_id ELSE {0} END".format(
        _some("product_description", "product_name", "product_category", "search_query", "event_type")
    ),
    "labelled": "concat_ws(' ', nullif(product_description, ''), "
    "'Product: ' || coalesce(product_name, ''), 'Category: ' || coalesce(product_category, ''))",
}


def _text_query(preset: str):
    @query(f"text_{preset}", with_sql("ev", body=f"SELECT event_id, {_TEXT_SQL[preset]} AS text FROM ev"))
    def build(spark, sf_dir):
        rows = tables.events(spark, sf_dir).select("event_id", TEXT_PRESETS[preset]().alias("text"))
        return rows.filter(F.col("text") != "") if preset == "stream" else rows

    return build


for _preset in TEXT_PRESETS:
    _text_query(_preset)


@query("event_to_point", with_sql("ev", body=f"""
SELECT event_id AS id, text, product_id, product_category, product_price, total_amount,
  {hash_vector_sql('text')}
FROM (SELECT *, {STREAM_SQL} AS text FROM ev)"""))
def event_to_point(spark, sf_dir):
    points = ops.events_to_points(tables.events(spark, sf_dir))
    return points.select(
        "id", "payload.text", "payload.product_id", "payload.product_category",
        "payload.product_price", "payload.total_amount", *hash_vector_columns(),
    )


@query("parse_events", with_sql("ev", body="""
SELECT user_id AS message_key, 'ecommerce-events' AS topic, CAST(eid % 16 AS INTEGER) AS partition,
  eid AS "offset", ts AS kafka_timestamp, event_id, timestamp, event_type, session_id, product_id, product_name,
  product_description, product_price, search_query, results_count, quantity, total_amount, payment_method,
  view_duration, TIMESTAMP '2024-02-01 00:00:00' AS processing_timestamp
FROM ev WHERE eid % 50 <> 0"""))
def parse_events(spark, sf_dir):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    parsed = ops.parse_events(tables.raw_records(spark, sf_dir), now)
    return parsed.select(
        "message_key", "topic", "partition", "offset", plain_time("kafka_timestamp"), "event_id",
        "timestamp", "event_type", "session_id", F.col("product.id").alias("product_id"),
        F.col("product.name").alias("product_name"),
        F.col("product.description").alias("product_description"),
        F.col("product.price").alias("product_price"), "search_query", "results_count", "quantity",
        "total_amount", "payment_method", "view_duration", plain_time("processing_timestamp"),
    )


@query("event_times", "SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_time FROM events")
def event_times(spark, sf_dir):
    rows = tables.events(spark, sf_dir).select("event_id", ops.event_time().alias("event_time"))
    return rows.select("event_id", plain_time("event_time"))


@query("parse_messages", """
SELECT doc_id AS "offset", 'doc_' || doc_id AS id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE text END AS content,
  '2024-01-01T00:00:00Z' AS timestamp, CASE WHEN doc_id % 10 <> 0 THEN source END AS source
FROM documents""")
def parse_messages(spark, sf_dir):
    messages = tables.messages(spark, sf_dir)
    value = F.to_json(F.struct(*messages.columns)).cast("binary")
    raw = messages.select(
        F.col("id").cast("binary").alias("key"), value.alias("value"), F.lit("messages").alias("topic"),
        F.lit(0).alias("partition"), F.substring_index("id", "_", -1).cast("bigint").alias("offset"),
        F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
    )
    parsed = ops.parse_messages(raw)
    return parsed.select("offset", "id", "content", "timestamp", F.col("metadata")["source"].alias("source"))


@query("malformed_split", with_sql("ev", body="""
SELECT eid AS "offset", eid % 50 = 0 AS malformed,
  CASE WHEN eid % 50 = 0 THEN 'validation_error' END AS reason FROM ev"""))
def malformed_split(spark, sf_dir):
    decoded = ops.decode_events(tables.raw_records(spark, sf_dir))
    reason = F.when(F.col("malformed"), F.lit("validation_error"))
    return decoded.select("offset", "malformed", reason.alias("reason"))


@query("malformed_letters", with_sql("ev", body="""
SELECT 'ecommerce-events' AS original_topic, CAST(eid % 16 AS INTEGER) AS original_partition, eid AS original_offset,
  user_id AS original_key, 'validation_error' AS failure_reason, 'malformed JSON' AS error_message, ts AS failed_at,
  0 AS retry_count
FROM ev WHERE eid % 50 = 0"""))
def malformed_letters(spark, sf_dir):
    decoded = ops.decode_events(tables.raw_records(spark, sf_dir))
    letters = ops.malformed_letters(decoded, F.col("kafka_timestamp"))
    return letters.withColumn("failed_at", plain_time("failed_at")).drop("original_value", "original_headers")


@query("event_validity", with_sql("ev", body="""
SELECT event_id, concat_ws(',', CASE WHEN NOT has_product THEN 'missing_product' END,
  CASE WHEN has_product AND product_description IS NULL THEN 'missing_product_description' END) AS broken,
  has_product AND product_description IS NOT NULL AS valid
FROM ev"""))
def event_validity(spark, sf_dir):
    checked = ops.with_validity(tables.events(spark, sf_dir))
    return checked.select("event_id", F.array_join("broken_rules", ",").alias("broken"), "valid")


_REQUIRED, _OF_PRODUCT = ops.REQUIRED_FIELDS, ops.PRODUCT_FIELDS
_DAMAGED = "eid % 16"


def _rules_sql():
    lost = lambda k, rule: f"CASE WHEN {_DAMAGED} = {k} THEN '{rule}' END"
    there = f"has_product AND {_DAMAGED} <> {_REQUIRED.index('product')}"
    rules = [lost(k, f"missing_{f}") for k, f in enumerate(_REQUIRED)]
    rules[_REQUIRED.index("product")] = f"CASE WHEN NOT ({there}) THEN 'missing_product' END"
    for k, f in enumerate(_OF_PRODUCT, len(_REQUIRED)):
        empty = " OR product_description IS NULL" if f == "description" else ""
        rules.append(f"CASE WHEN {there} AND ({_DAMAGED} = {k}{empty}) THEN 'missing_product_{f}' END")
    rules.append(f"CASE WHEN {there} AND {_DAMAGED} = 11 THEN 'price_not_numeric' END")
    return f"""
SELECT eid AS "offset", concat_ws(',', {", ".join(rules)}) AS broken,
  concat_ws(',', CASE WHEN {there} AND {_DAMAGED} = 11 THEN 'product.price' END,
    CASE WHEN {_DAMAGED} = 12 AND quantity IS NOT NULL THEN 'quantity' END) AS wrong,
  CASE WHEN {_DAMAGED} <> 12 THEN quantity END AS quantity, CASE WHEN {_DAMAGED} <> 3 THEN event_type END AS event_type
FROM ev WHERE eid % 50 <> 0"""


@query("event_rules", with_sql("ev", body=_rules_sql()))
def event_rules(spark, sf_dir):
    """Raw records that lack one field after the other, with prices and quantities as texts:
    each one names the rule it breaks, and the rest of it survives."""
    rows, damage = tables.events(spark, sf_dir), F.pmod("eid", F.lit(16))
    for k, f in enumerate(_REQUIRED):
        rows = rows.withColumn(f, F.when(damage != k, F.col(f)))
    product = F.col("product")
    for k, f in enumerate(_OF_PRODUCT, len(_REQUIRED)):
        product = product.withField(f, F.when(damage != k, F.col(f"product.{f}")))
    raw = tables.as_raw(rows.withColumn("product", F.when(F.col("product").isNotNull(), product)))
    place, value = F.pmod("offset", F.lit(16)), F.col("value").cast("string")
    spoiled = F.when(place == 11, F.regexp_replace(value, r'"price":([0-9.Ee+-]+)', '"price":"$1 EUR"')).when(
        place == 12, F.regexp_replace(value, r'"quantity":(\d+)', '"quantity":"$1 pieces"')
    ).otherwise(value)
    checked = ops.with_validity(ops.parse_events_by_field(raw.withColumn("value", spoiled.cast("binary"))))
    return checked.select(
        "offset", F.array_join("broken_rules", ",").alias("broken"), F.array_join("wrong_types", ",").alias("wrong"), "quantity", "event_type"
    )


@query("point_payload", with_sql("ev", body=f"""
SELECT event_id, timestamp, event_type, user_id, session_id, {_TEXT_SQL['pipeline']} AS text,
  product_id, product_name, product_description, product_category, product_price, search_query, results_count,
  quantity, total_amount, payment_method, TIMESTAMP '2024-02-01 00:00:00' AS processed_at,
  'hash' AS embedding_model, '1.0.0' AS pipeline_version
FROM ev"""))
def point_payload(spark, sf_dir):
    payload = ops.point_payload(
        tables.events(spark, sf_dir), pipeline_text(), F.lit("2024-02-01").cast("timestamp"),
        embedding_model="hash", pipeline_version="1.0.0",
    )
    return payload.withColumn("processed_at", plain_time("processed_at"))


@query("purchase_amount", with_sql("ev", body="""
SELECT event_id, quantity, total_amount, product_price * quantity AS expected_amount, true AS amount_matches
FROM ev WHERE event_type = 'purchase'"""))
def purchase_amount(spark, sf_dir):
    checked = ops.with_purchase_check(tables.events(spark, sf_dir))
    return checked.select("event_id", "quantity", "total_amount", "expected_amount", "amount_matches")


@query("message_points", f"""
SELECT 'doc_' || doc_id AS id, text AS content, '2024-01-01T00:00:00Z' AS timestamp,
  CASE WHEN doc_id % 10 <> 0 THEN source ELSE 'unknown' END AS source, {hash_vector_sql('text')}
FROM documents WHERE doc_id % 7 <> 0 AND text <> ''""")
def message_points(spark, sf_dir):
    points = ops.messages_to_points(tables.messages(spark, sf_dir))
    return points.select("id", "payload.*", *hash_vector_columns())


@query("hash_embedding", f"""
SELECT doc_id, {hash_vector_sql('text')} FROM documents""")
def hash_embedding(spark, sf_dir):
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", hash_vector(F.col("text")).alias("vector"))
    return docs.select("doc_id", *hash_vector_columns())


@query("event_type_summary", with_sql("ev", body="""
SELECT event_type, count(*) AS n_events, round(coalesce(sum(total_amount), 0), 4) AS total_amount FROM ev GROUP BY 1"""))
def event_summary(spark, sf_dir):
    summary = event_type_summary(tables.events(spark, sf_dir))
    return summary.select("event_type", "n_events", rounded("total_amount", 4))
