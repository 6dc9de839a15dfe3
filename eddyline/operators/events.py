"""Parsing, checking and flattening of behaviour events and simple messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.functions.text import stable_id, stream_text
from eddyline.functions.vectors import stored_hash_vector
from eddyline.schemas import EVENT, MESSAGE, VECTOR_WIDTH

CORRUPT = "_corrupt"
# The fields of a product.
PRODUCT_FIELDS = ("id", "name", "description", "category", "price")
# The fields an event must carry.
REQUIRED_FIELDS = ("event_id", "timestamp", "user_id", "event_type", "product", "session_id")


def _decode(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Kafka columns plus the parsed struct; one JSON parse per record."""
    tagged = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    return raw.select(
        F.col("key").cast("string").alias("message_key"),
        text.alias("message_value"),
        "topic", "partition", "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        # Out of a generator, which filters and projections do not pass: parsed once.
        F.explode(F.array(F.from_json(text, tagged, {"columnNameOfCorruptRecord": CORRUPT}))).alias("parsed"),
    )


def is_malformed() -> Column:
    """'' and NULL give no struct at all; other bad JSON is flagged by the parser."""
    flagged = F.col("parsed").isNull() | F.col(f"parsed.{CORRUPT}").isNotNull()
    return flagged


def decode_events(raw: DataFrame) -> DataFrame:
    return _decode(raw, EVENT).withColumn("malformed", is_malformed())


def decode_messages(raw: DataFrame) -> DataFrame:
    return _decode(raw, MESSAGE).withColumn("malformed", is_malformed())


def _leaf_types() -> list[tuple[str, T.DataType]]:
    """(path, type) of every field of an event, those of the product below it."""
    return [(f"product.{f.name}", f.dataType) for f in EVENT["product"].dataType.fields] + [
        (f.name, f.dataType) for f in EVENT.fields if f.name != "product"
    ]


def decode_events_by_field(raw: DataFrame) -> DataFrame:
    """As ``decode_events``, but a field of the wrong type costs that field only.

    The text is parsed once, to a VARIANT. A field whose value is of another kind is NULL
    and named in ``wrong_types``: a text or an object where a number is due, an object or
    array where a text is due, a number with a fraction where a whole one is due. Numbers
    and booleans are taken as texts. Malformed is only what is no JSON object.
    """
    text = F.col("value").cast("string")
    parsed = F.explode(F.array(F.try_parse_json(text))).alias("v")
    rows = raw.select(
        F.col("key").cast("string").alias("message_key"), text.alias("message_value"), "topic", "partition", "offset",
        F.col("timestamp").alias("kafka_timestamp"), parsed,
    )
    v = F.col("v")
    # Every field is looked up once, in a generator, however often rules ask for it.
    kind = lambda path: F.schema_of_variant(F.try_variant_get(v, f"$.{path}", "variant"))
    looks, number = [kind("product").alias("product")], {"product": 0}
    for path, of in _leaf_types():
        number[path], name = len(number), of.simpleString()
        looks += [kind(path).alias(f"kind{number[path]}"), F.try_variant_get(v, f"$.{path}", name).alias(f"value{number[path]}")]
        if name == "int":
            looks.append(F.try_variant_get(v, f"$.{path}", "double").alias(f"double{number[path]}"))
    looks.append(F.schema_of_variant(v).alias("whole"))
    looked = rows.select("*", F.explode(F.array(F.struct(*looks))).alias("seen"))
    wrong, taken = [], {}
    is_object = F.col("seen.product").startswith("OBJECT")
    wrong.append(F.when(~(is_object | F.col("seen.product").isin("VOID")), F.lit("product")))
    for path, of in _leaf_types():
        name = of.simpleString()
        found, value = F.col(f"seen.kind{number[path]}"), F.col(f"seen.value{number[path]}")
        if name == "string":
            good = ~found.rlike("^(OBJECT|ARRAY)")
        else:
            good = found.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT|INT)") & value.isNotNull()
            if name == "int":
                good &= F.col(f"seen.double{number[path]}") == value
        good = F.coalesce(good, F.lit(False))
        present = F.coalesce(found != "VOID", F.lit(False))
        taken[path] = F.when(present & good, value)
        wrong.append(F.when(present & ~good, F.lit(path)))
    product = F.struct(*[taken[f"product.{f.name}"].alias(f.name) for f in EVENT["product"].dataType.fields])
    fields = [F.when(is_object, product).alias("product") if f.name == "product" else taken[f.name].alias(f.name) for f in EVENT.fields]
    malformed = v.isNull() | ~F.col("seen.whole").startswith("OBJECT")
    broken = F.coalesce(malformed, F.lit(True))
    return looked.select(
        *[c for c in rows.columns if c != "v"], F.when(~broken, F.struct(*fields)).alias("parsed"), broken.alias("malformed"),
        F.when(~broken, F.array_compact(F.array(*wrong))).alias("wrong_types"),
    )


def split_malformed(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, rows that did not): two filters over one parse."""
    return decoded.filter(~F.col("malformed")), decoded.filter("malformed")


def _flat(decoded: DataFrame, schema: T.StructType, now: Column, *more: str) -> DataFrame:
    fields = [F.col(f"parsed.{f.name}").alias(f.name) for f in schema.fields]
    return decoded.select(
        "message_key", "topic", "partition", "offset", "kafka_timestamp",
        *fields, now.alias("processing_timestamp"), *more,
    )


def parse_events(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """Well-formed events with their Kafka coordinates."""
    good, _ = split_malformed(decode_events(raw))
    return _flat(good, EVENT, F.current_timestamp() if now is None else now)


def parse_events_by_field(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """Events with their Kafka coordinates and ``wrong_types``; what is no object is left out."""
    good, _ = split_malformed(decode_events_by_field(raw))
    return _flat(good, EVENT, F.current_timestamp() if now is None else now, "wrong_types")


def parse_messages(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """Well-formed messages; ``malformed_letters(decode_messages(raw), ...)`` has the rest."""
    good, _ = split_malformed(decode_messages(raw))
    return _flat(good, MESSAGE, F.current_timestamp() if now is None else now)


def malformed_letters(decoded: DataFrame, failed_at: Column) -> DataFrame:
    """Dead letters for the records that are not JSON objects."""
    from eddyline.operators.deadletters import dead_letter_rows

    _, bad = split_malformed(decoded)
    return dead_letter_rows(
        bad, key="message_key", value="message_value",
        reason=F.lit("validation_error"), error=F.lit("malformed JSON"), failed_at=failed_at,
    )


def event_time() -> Column:
    """The ISO-8601 event time as TIMESTAMP; NULL when it does not parse."""
    return F.try_to_timestamp(F.col("timestamp"))


def broken_rules(wrong_types: Column | None = None) -> Column:
    """Names of the validity rules an event breaks; an empty array means valid.

    With ``wrong_types`` (``decode_events_by_field``) a price that is there and no number
    breaks the rule for that, and is not missing besides.
    """
    checks = [F.when(F.col(f).isNull(), F.lit(f"missing_{f}")) for f in REQUIRED_FIELDS]
    product = F.col("product")
    price = F.col("product.price")
    not_numeric = F.coalesce(F.isnan(price), F.lit(False))
    if wrong_types is not None:
        not_numeric = not_numeric | F.coalesce(F.array_contains(wrong_types, "product.price"), F.lit(False))
    for f in PRODUCT_FIELDS:
        missing = product.isNotNull() & F.col(f"product.{f}").isNull()
        checks.append(F.when(missing & ~not_numeric if f == "price" else missing, F.lit(f"missing_product_{f}")))
    checks.append(F.when(not_numeric, F.lit("price_not_numeric")))
    return F.array_compact(F.array(*checks))


def with_validity(events: DataFrame) -> DataFrame:
    wrong = F.col("wrong_types") if "wrong_types" in events.columns else None
    checked = events.withColumn("broken_rules", broken_rules(wrong))
    return checked.withColumn("valid", F.size("broken_rules") == 0)


def product_columns() -> list[Column]:
    return [F.col(f"product.{f}").alias(f"product_{f}") for f in PRODUCT_FIELDS]


def with_purchase_check(events: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Purchases with the amount recomputed as price x quantity beside the stated one."""
    purchases = events.filter(F.col("event_type") == "purchase")
    expected = F.col("product.price") * F.col("quantity")
    return purchases.withColumn("expected_amount", expected).withColumn(
        "amount_matches", F.abs(F.col("total_amount") - expected) <= tolerance
    )


def point_payload(
    events: DataFrame, text: Column, processed_at: Column | None = None, **constants
) -> DataFrame:
    """The flat payload of a point; ``constants`` add fixed fields such as a model name."""
    return events.select(
        "event_id", "timestamp", "event_type", "user_id", "session_id",
        text.alias("text"),
        *product_columns(),
        "search_query", "results_count", "quantity", "total_amount", "payment_method",
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
        *[F.lit(v).alias(k) for k, v in constants.items()],
    )


def events_to_points(
    events: DataFrame,
    text: Column | None = None,
    vector=stored_hash_vector,
    width: int = VECTOR_WIDTH,
    carry: tuple[str, ...] = (),
    processed_at: Column | None = None,
    **constants,
) -> DataFrame:
    """Text, vector and payload in one narrow pass; events without text give no point.

    An event without an id gets the hash of its own fields, so such events stay apart and
    a replay finds them again. ``processed_at`` and ``constants`` are stored, not hashed.
    """
    made = event_texts(events, text, processed_at, carry, **constants)
    return made.select(
        "id", vector(F.col("payload.text"), width).cast("array<float>").alias("vector"), "payload", *carry
    )


def event_texts(
    events: DataFrame, text: Column | None = None, processed_at: Column | None = None,
    carry: tuple[str, ...] = (), **constants,
) -> DataFrame:
    """``id, payload`` of the events that have text, for an encoder to add vectors to."""
    text = stream_text() if text is None else text
    with_text = events.withColumn("text", text).filter(F.col("text") != "")
    own = [
        "event_id", "timestamp", "event_type", "user_id", "session_id", "text", "search_query",
        "results_count", "quantity", "total_amount", "payment_method", "view_duration", *product_columns(),
    ]
    added = [F.lit(v).alias(k) for k, v in constants.items()]
    if processed_at is not None:
        added.insert(0, processed_at.alias("processed_at"))
    return with_text.select(
        stable_id(F.col("event_id"), F.struct(*own)).alias("id"), F.struct(*own, *added).alias("payload"), *carry
    )


def messages_to_points(
    messages: DataFrame, vector=stored_hash_vector, width: int = VECTOR_WIDTH, source: Column | None = None
) -> DataFrame:
    """Messages with content as points; the source comes from the metadata."""
    if source is None:
        source = F.coalesce(F.col("metadata").getItem("source"), F.lit("unknown"))
    has_content = F.col("content").isNotNull() & (F.col("content") != "")
    payload = F.struct("content", F.coalesce("timestamp", F.lit("")).alias("timestamp"), source.alias("source"))
    return messages.filter(has_content).select(
        stable_id(F.col("id"), payload).alias("id"),
        vector(F.col("content"), width).cast("array<float>").alias("vector"),
        payload.alias("payload"),
    )
