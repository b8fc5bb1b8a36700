"""JSON-Schema rules (F6) and dead-letter routing / keys."""

import json

import pytest
from pyspark.sql import functions as F

from tributary.fixed import CDC_SCHEMA, CLICKSTREAM_SCHEMA, USER_PROFILE_SCHEMA
from tributary.functions.jsonrules import SchemaRegistry, with_violations
from tributary.operators import routing as R

CLICK = {"event_id": "e1", "user_id": "USER-001", "timestamp": "2024-01-01T00:00:00Z",
         "event_type": "page_view", "product_id": "PROD-0001", "session_id": "s1",
         "metadata": {"page_url": "/", "cart_value": 49.99, "quantity": 2}}


def errors(spark, docs, schema):
    texts = [d if isinstance(d, str) else json.dumps(d) for d in docs]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    rows = with_violations(df, "value", schema).orderBy("i").collect()
    return [list(r.errors) for r in rows]


def test_clickstream_cases(spark):
    missing = {k: v for k, v in CLICK.items() if k not in ("user_id", "session_id")}
    docs = [CLICK, missing, dict(CLICK, event_type="bogus"), dict(CLICK, product_id=None),
            dict(CLICK, extra_field=1), {}, "{bad",
            dict(CLICK, metadata={"cart_value": "49.99", "quantity": 1.0}),
            dict(CLICK, metadata={"quantity": 1.5}), dict(CLICK, event_id=5), [1, 2]]
    out = errors(spark, docs, CLICKSTREAM_SCHEMA)
    assert out[0] == []
    assert out[1] == ["'user_id' is a required property", "'session_id' is a required property"]
    assert out[2] == ["'event_type' is not one of ['page_view', 'add_to_cart', 'purchase', "
                      "'search', 'user_login']"]
    assert out[3] == [] and out[4] == []
    assert len(out[5]) == 5 and out[6] == ["malformed"]
    assert out[7] == ["'metadata.cart_value' is not of type 'number'"]
    assert out[8] == ["'metadata.quantity' is not of type 'integer'"]
    assert out[9] == ["'event_id' is not of type 'string'"]
    assert out[10] == ["'$' is not of type 'object'"]


def test_all_event_types_valid(spark):
    docs = [dict(CLICK, event_type=t) for t in CLICKSTREAM_SCHEMA["properties"]["event_type"]["enum"]]
    assert all(e == [] for e in errors(spark, docs, CLICKSTREAM_SCHEMA))


def test_cdc_cases(spark):
    base = {"op": "c", "ts_ms": 1, "source": {"table": "users", "db": "x"},
            "before": None, "after": {"user_id": "u1"}}
    docs = [dict(base, op=o) for o in "cudr"] + [dict(base, after=None),
                                                  dict(base, op="x"),
                                                  {k: v for k, v in base.items() if k != "before"},
                                                  dict(base, ts_ms=1.5)]
    out = errors(spark, docs, CDC_SCHEMA)
    assert out[:5] == [[], [], [], [], []]
    assert out[5] == ["'op' is not one of ['c', 'u', 'd', 'r']"]
    assert out[6] == ["'before' is a required property"]
    assert out[7] == ["'ts_ms' is not of type 'integer'"]


def test_profile_cases(spark):
    docs = [{"user_id": "u1", "name": "A", "email": "a@x", "preferences": {}},
            {"user_id": "u1"}, {"name": "A"}]
    assert errors(spark, docs, USER_PROFILE_SCHEMA) == [
        [], [], ["'user_id' is a required property"]]


def test_registry():
    reg = SchemaRegistry()
    assert reg.list_schemas() == ["clickstream", "cdc", "user_profile"]
    assert reg.get_schema("nope") is None
    reg.register_schema("x", {"type": "object"})
    assert reg.get_schema("x") == {"type": "object"}


def test_routing_and_keys(spark):
    ok = dict(CLICK, user_id="USER-001")
    bad = {k: v for k, v in CLICK.items() if k != "event_type"}
    df = spark.createDataFrame([(json.dumps(ok),), (json.dumps(bad),)], "value string")
    v = R.validate(df, CLICKSTREAM_SCHEMA)
    sent = R.accepted(v).select(R.clickstream_key(F.col("value")).alias("k")).collect()
    assert [r.k for r in sent] == ["USER-001"]
    dlq = R.dlq_envelope(R.rejected(v), "clickstream-events").collect()
    assert len(dlq) == 1 and dlq[0].error == "'event_type' is a required property"
    assert dlq[0].original_topic == "clickstream-events" and dlq[0].timestamp is not None
    m = R.routing_metrics(v, None).first()
    assert (m.sent, m.dlq) == (1, 1)


@pytest.mark.parametrize("doc,key", [
    ({"after": {"user_id": "a"}, "before": {"user_id": "b"}}, "a"),
    ({"after": None, "before": {"user_id": "b"}}, "b"),
    ({"after": {}, "before": {"user_id": "b"}}, "b"),
    ({"after": {"name": "x"}, "before": {"user_id": "b"}}, "unknown"),
    ({"after": None, "before": None}, "unknown"),
])
def test_cdc_key(spark, doc, key):
    df = spark.createDataFrame([(json.dumps(doc),)], "value string")
    assert R.with_cdc_key(df).first().key == key
