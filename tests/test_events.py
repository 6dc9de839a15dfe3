import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.functions.text import TEXT_PRESETS, strip
from eddyline.functions.vectors import has_width, hash_vector, l2_normalize
from eddyline.operators import events as ops
from eddyline.schemas import EVENT, KAFKA_ENVELOPE


def event(**fields):
    row = {name: None for name in EVENT.names}
    row.update(fields)
    return row


def product(id="p", name="n", description="d", category="c", price=1.0):
    return dict(id=id, name=name, description=description, category=category, price=price)


def texts(spark, rows):
    df = spark.createDataFrame(rows, EVENT)
    return [r.asDict() for r in df.select(*[f().alias(n) for n, f in TEXT_PRESETS.items()]).collect()]


def test_texts_of_a_full_event(spark):
    row = event(event_id="1", event_type="view", product=product("p", "Lamp", "bright", "home"), search_query="q")
    assert texts(spark, [row])[0] == {
        "stream": "view Lamp bright home q",
        "partition": "view Lamp bright home",
        "pipeline": "Lamp bright home q view",
        "task": "bright Lamp home q view",
        "labelled": "bright Product: Lamp Category: home",
    }


def test_texts_tell_null_from_empty(spark):
    row = event(event_id="1", event_type="view", product=product("p", "", None, "home"), search_query="")
    got = texts(spark, [row])[0]
    assert got["stream"] == "view  home "
    assert got["partition"] == "view   home"
    assert got["pipeline"] == "home view" and got["task"] == "home view"
    assert got["labelled"] == "Product:  Category: home"


def test_texts_without_anything(spark):
    got = texts(spark, [event(event_id="7"), event()])
    assert [g["pipeline"] for g in got] == ["event_7", "event_unknown"]
    assert [g["task"] for g in got] == ["event_7", "event_unknown"]
    assert got[0]["stream"] == "" and got[0]["partition"] == ""


def test_strip_removes_every_white_space(spark):
    df = spark.createDataFrame([("\t a b\n",), (None,)], "t string")
    assert [r[0] for r in df.select(strip(F.col("t"))).collect()] == ["a b", None]


@pytest.mark.parametrize("width", [384, 64, 20])
def test_hash_vector_equals_md5(spark, width):
    samples = ["abc", "é ü", "x" * 5000, "", None]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    for text, (vector,) in zip(samples, df.select(hash_vector(F.col("t"), width)).collect()):
        digest = hashlib.md5(text.encode()).digest() if text else bytes(16)
        assert vector == [digest[i % 16] / 255.0 for i in range(width)]


def test_normalize_and_width(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([1.0],), (None,), ([1.0, None],)], "v array<double>")
    rows = df.select(l2_normalize(F.col("v")), has_width(F.col("v"), 2)).collect()
    assert rows[0][0] == [0.6, 0.8] and rows[1][0] == [0.0, 0.0]
    assert [r[1] for r in rows] == [True, True, False, False, False]


BAD = ["{invalid json}", "not json at all", "", '{"incomplete": }', "invalid json content", "[1]", None, '{"quantity": "x"}']
GOOD = ['{"event_id": "1", "product": null}', '{"event_id": "2", "product": {"id": "a", "price": 2}}', "{}"]


def envelope(spark, values):
    rows = [(None, v.encode() if v is not None else None, "t", 0, i, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, KAFKA_ENVELOPE)


def test_malformed_kinds(spark):
    decoded = ops.decode_events(envelope(spark, BAD + GOOD))
    flags = {r.offset: r.malformed for r in decoded.collect()}
    assert [flags[i] for i in range(len(BAD))] == [True] * len(BAD)
    assert [flags[len(BAD) + i] for i in range(len(GOOD))] == [False] * len(GOOD)
    good, bad = ops.split_malformed(decoded)
    assert (good.count(), bad.count()) == (len(GOOD), len(BAD))
    letters = ops.malformed_letters(decoded, F.current_timestamp()).collect()
    assert {r.failure_reason for r in letters} == {"validation_error"} and len(letters) == len(BAD)


def test_bytes_that_are_not_utf8_become_a_dead_letter(spark):
    df = spark.createDataFrame([(None, b"\xff\xfe{", "t", 0, 0, None)], KAFKA_ENVELOPE)
    assert ops.decode_events(df).first().malformed


def test_validity_rules(spark):
    full = event(event_id="1", timestamp="t", user_id="u", event_type="e", session_id="s", product=product())
    no_price = dict(full, product=product(price=None))
    rows = [full, dict(full, product=None), no_price, event(product=product(price=float("nan")))]
    got = ops.with_validity(spark.createDataFrame(rows, EVENT)).collect()
    assert got[0].valid and got[0].broken_rules == []
    assert got[1].broken_rules == ["missing_product"]
    assert got[2].broken_rules == ["missing_product_price"]
    assert "price_not_numeric" in got[3].broken_rules and "missing_event_id" in got[3].broken_rules


def test_events_without_text_give_no_point(spark):
    df = spark.createDataFrame([event(event_id="1"), event(event_id="2", event_type="x")], EVENT)
    assert [r.id for r in ops.events_to_points(df).collect()] == ["2"]


def test_messages_to_points(spark):
    schema = "id string, content string, timestamp string, metadata map<string,string>"
    rows = [("a", "hi", "t", {"source": "web"}), ("b", "", "t", None), ("c", None, "t", None), ("d", "x", None, None)]
    got = {r.id: r.payload for r in ops.messages_to_points(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"a", "d"}
    assert got["a"].source == "web" and got["d"].source == "unknown" and got["d"].timestamp == ""


def test_event_time_parses_iso_forms(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = [event(timestamp=t) for t in ("2024-01-15T10:00:00Z", "2024-01-15T10:00:00.123456Z", "yesterday")]
    got = spark.createDataFrame(rows, EVENT).select(ops.event_time().cast("string")).collect()
    assert [r[0] for r in got] == ["2024-01-15 10:00:00", "2024-01-15 10:00:00.123456", None]


def test_envelope_types():
    assert KAFKA_ENVELOPE["value"].dataType == T.BinaryType()


def test_a_wrong_type_costs_its_field_only(spark):
    import json

    whole = {
        "event_id": "1", "timestamp": "2024-01-01T00:00:00Z", "user_id": "u", "event_type": "purchase", "session_id": "s", "quantity": 2,
        "total_amount": 9.5, "product": {"id": "p", "name": "n", "description": "d", "category": "c", "price": 4.75},
    }
    product = lambda **f: whole | {"product": whole["product"] | f}
    cases = [
        (whole, [], []), (whole | {"quantity": "two"}, ["quantity"], []), (whole | {"quantity": 1.5}, ["quantity"], []), (whole | {"quantity": 3.0}, [], []),
        (product(price="4 EUR"), ["product.price"], ["price_not_numeric"]), (product(price="4.75"), ["product.price"], ["price_not_numeric"]),
        (product(price={"eur": 4}), ["product.price"], ["price_not_numeric"]), (product(price=None), [], ["missing_product_price"]),
        (whole | {"event_id": 7}, [], []), (whole | {"user_id": ["u"]}, ["user_id"], ["missing_user_id"]), (whole | {"product": "p"}, ["product"], ["missing_product"]),
        (whole | {"product": None}, [], ["missing_product"]), (whole | {"view_duration": 10**12}, ["view_duration"], []), (product(name={"a": 1}), ["product.name"], ["missing_product_name"]),
        (whole | {"total_amount": True}, ["total_amount"], []),
    ]
    texts = [json.dumps(c[0]) for c in cases] + ["", None, "[1]", "12", '{"event_id": "1"', "null"]
    raw = spark.createDataFrame(
        [(b"k", None if t is None else t.encode(), "t", 0, i, None) for i, t in enumerate(texts)],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp",
    )
    decoded = ops.decode_events_by_field(raw)
    assert [r.malformed for r in decoded.orderBy("offset").collect()] == [False] * len(cases) + [True] * 6
    got = ops.with_validity(ops.parse_events_by_field(raw)).orderBy("offset").collect()
    for r, (record, wrong, rules) in zip(got, cases, strict=True):
        assert (r.wrong_types, r.broken_rules) == (wrong, rules), record
        assert r.session_id == "s" and (r.product is None or r.product.category == "c")
    assert got[8].event_id == "7" and got[3].quantity == 3 and got[1].total_amount == 9.5
    # Where no type is wrong both decoders agree.
    plain = ops.parse_events(raw).drop("processing_timestamp").filter("offset = 0").collect()
    assert plain == ops.parse_events_by_field(raw).drop("processing_timestamp", "wrong_types").filter("offset = 0").collect()


def test_the_catalogue_is_not_broadcast(spark):
    """It grows with the events, and a stream would send it through the driver each epoch."""
    from eddyline.plans import tables

    rows = tables.events(spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_every_field_is_looked_up_once(spark):
    raw = spark.createDataFrame([], "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp")
    limit = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "10000")
    try:
        plan = ops.parse_events_by_field(raw)._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set(limit, before)
    assert plan.count("schema_of_variant(") == 2 + len(ops._leaf_types())
