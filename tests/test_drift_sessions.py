"""Schema drift kept and listed; sessions by inactivity gap."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import bronze as B
from tributary.operators import drift as DR
from tributary.operators import sessions as SE
from tributary.sources.kafka import KAFKA_SCHEMA
from tributary.streaming import jobs as J

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


# --- drift

def feed(spark, values, minute=0):
    return spark.createDataFrame(
        [(b"k", v if v is None else (v if isinstance(v, bytes) else json.dumps(v).encode()), "t", 0, i,
          T0 + dt.timedelta(minutes=minute + i), 0) for i, v in enumerate(values)], KAFKA_SCHEMA)


OK = {"event_id": "1", "user_id": "u", "timestamp": "2024-01-01T12:00:00.000000Z", "event_type": "search",
      "session_id": "s", "product_id": None, "metadata": {"quantity": 2, "cart_value": 5}}


def listed(df):
    return sorted((r.field, r.type, r.kind, r.rows) for r in df.collect())


def test_fields_that_differ(spark):
    values = [OK, OK | {"campaign": "x"}, OK | {"campaign": 7, "event_id": 5}, OK | {"product_id": 4},
              OK | {"metadata": {"quantity": 1.5, "cart_value": "9", "deep": {"er": {"est": 1}}}},
              OK | {"metadata": [1]}, OK | {"metadata": {"quantity": 2.0, "cart_value": 1e40}},
              b"{bad", None, b"[1]", b"3", b"{}", OK | {"odd.name": True}]
    got = listed(DR.drift(DR.bronze_with_payload(feed(spark, values))))
    assert got == sorted([
        ("$", "array", "new", 1), ("$", "integer", "new", 1), ("campaign", "integer", "new", 1),
        ("campaign", "string", "new", 1), ("event_id", "integer", "changed", 1),
        ("metadata", "array", "changed", 1), ("metadata.cart_value", "string", "changed", 1),
        ("metadata.deep", "object", "new", 1), ("metadata.quantity", "number", "changed", 1),
        ("odd.name", "boolean", "new", 1), ("product_id", "integer", "changed", 1)])
    deeper = listed(DR.drift(DR.bronze_with_payload(feed(spark, values)), depth=4))
    assert ("metadata.deep.er.est", "integer", "new", 1) in deeper


def test_declared_columns_are_those_of_bronze(spark):
    values = [OK, b"{bad", None, OK | {"campaign": "x"}]
    now = F.lit(T0).cast("timestamp")
    plain = B.process_bronze(feed(spark, values), now)
    kept = DR.bronze_with_payload(feed(spark, values), now=now)
    assert kept.columns == [*plain.columns, "payload"]
    assert sorted(map(str, kept.drop("payload").collect())) == sorted(map(str, plain.collect()))


def test_unknown_fields_are_stored_and_drift_adds_up(spark, tmp_path):
    write = DR.drift_batch_writer(f"{tmp_path}/bronze", f"{tmp_path}/drift")
    write(feed(spark, [OK, OK]), 0)
    write(feed(spark, [OK | {"campaign": "x"}, OK], 10), 1)
    write(feed(spark, [OK] * 5), 1)             # a repeated batch, however it looks
    write(feed(spark, [OK | {"campaign": "y"}], 20), 2)
    stored = spark.read.parquet(f"{tmp_path}/bronze")
    names = stored.select(DR.field_of(stored, "campaign", "string").alias("c"),
                          DR.field_of(stored, "metadata.quantity", "int").alias("q")).collect()
    assert sorted(r.c for r in names if r.c) == ["x", "y"] and [r.q for r in names] == [2] * 5
    r, = DR.drift_so_far(spark, f"{tmp_path}/drift").collect()
    assert (r.field, r.type, r.kind, r.rows) == ("campaign", "string", "new", 2)
    assert (r.first_seen, r.last_seen) == (T0 + dt.timedelta(minutes=10), T0 + dt.timedelta(minutes=20))
    assert spark.read.parquet(f"{tmp_path}/drift").where("batch_id = 0").count() == 0


def test_drift_of_nothing(spark):
    assert DR.drift(DR.bronze_with_payload(feed(spark, []))).count() == 0
    assert DR.drift(DR.bronze_with_payload(feed(spark, [None, b"no json"]))).count() == 0


# --- sessions

SILVER = ("event_id string, user_id string, event_timestamp timestamp, event_type string, cart_value double, "
          "page_url string")


def clicks(spark, rows):
    """(user, minute or None, type)"""
    return spark.createDataFrame(
        [(f"e{i:04d}", u, None if m is None else T0 + dt.timedelta(minutes=m), kind,
          float(i) if i % 3 else None, f"/p{i}") for i, (u, m, kind) in enumerate(rows)], SILVER)


def brute(df):
    rows = sorted((r for r in df.collect() if r.user_id is not None and r.event_timestamp is not None),
                  key=lambda r: (r.user_id, r.event_timestamp, r.event_id))
    found = []
    for r in rows:
        if found and found[-1][0].user_id == r.user_id \
                and r.event_timestamp - found[-1][-1].event_timestamp <= dt.timedelta(minutes=30):
            found[-1].append(r)
        else:
            found.append([r])
    out = []
    for s in found:
        bought = [r.cart_value for r in s if r.event_type == "purchase" and r.cart_value is not None]
        kinds = [r.event_type for r in s]
        out.append((s[0].user_id, s[0].event_timestamp, s[-1].event_timestamp + dt.timedelta(minutes=30), len(s),
                    kinds.count("page_view"), kinds.count("add_to_cart"), kinds.count("purchase"),
                    sum(bought) if bought else None, s[0].page_url, s[-1].page_url))
    return sorted(out, key=str)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def some(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot"] * 5 + ["u1", "u2", "u3", None]), rng.choice([rng.randint(0, 3000), 30, 60, None]),
             rng.choice(["page_view", "add_to_cart", "purchase", "search"])) for _ in range(700)]
    return clicks(spark, rows)


@pytest.mark.parametrize("split", [False, True])
def test_sessions_equal_brute_force(spark, some, split):
    """``split``: one user over many ranges of time, sessions across their ends."""
    if split:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert plain(SE.sessions_by_gap(some)) == brute(some)
        assert plain(SE.sessions_of_hot_users(some)) == brute(some)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_session_over_all_ranges(spark):
    rows = clicks(spark, [("u", m, "page_view") for m in range(0, 4000, 20)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert plain(SE.sessions_of_hot_users(rows)) == brute(rows) and len(brute(rows)) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_gap_is_exact_and_nothing_gives_nothing(spark):
    rows = clicks(spark, [("u", 0, "search"), ("u", 30, "search"), ("u", 61, "search")])
    assert [r[3] for r in plain(SE.sessions_by_gap(rows))] == [2, 1] and plain(SE.sessions_by_gap(rows)) == brute(rows)
    for fn in (SE.sessions_by_gap, SE.sessions_of_hot_users):
        assert fn(clicks(spark, [])).count() == 0 and fn(clicks(spark, [(None, 1, "x"), ("u", None, "x")])).count() == 0


def test_late_event_joins_two_open_sessions(spark, tmp_path):
    src, like = f"{tmp_path}/silver", clicks(spark, [])

    def add(rows):
        clicks(spark, rows).coalesce(1).write.mode("append").parquet(src)
        SE.start_sessions(J.table_stream(spark, src, like), f"{tmp_path}/out", f"{tmp_path}/chk",
                          watermark="60 minutes", trigger={"availableNow": True}).awaitTermination()

    add([("u", 0, "page_view")])
    add([("u", 50, "purchase")])
    add([("u", 25, "search")])                  # between the two: one session
    add([("u", 500, "page_view")])              # closes it
    out = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [(r.session_start, r.session_end, r.events) for r in out] == [
        (T0, T0 + dt.timedelta(minutes=80), 3)]
