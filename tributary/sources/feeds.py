"""Feeds derived from the driver's tables.

The given tables hold no raw JSON messages, change feeds or user profiles, so
these Spark jobs derive them, row for row, from ``events`` and ``customer``:

* ``clickstream_messages`` — one Kafka record per event (plus producer
  re-sends), value = the event as JSON.  A few deterministic defects are
  injected by residue of ``event_id`` so that validation, dead-letter routing,
  lenient parsing and dedup all have work to do.  Every event stays in the
  feed; the residues choose *which* defect a row carries, never whether the
  row is present.
* ``cdc_messages`` — a Debezium-shaped change feed of users.
* ``profile_messages`` — user-profile JSON documents from ``customer``.

All columns are built with native expressions; the jobs are narrow (no
shuffle) and scale with their input, whose rows are dealt to all cores first
(``spread``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.fixed import TOPIC_CDC, TOPIC_CLICKSTREAM, UNKNOWN_KEY
from tributary.session import table_path

# Residues of event_id that select an injected defect (see module docstring).
CLICK_DEFECTS = {
    "malformed": 101,      # value is not JSON
    "missing_user": 97,    # user_id key absent
    "bad_type": 83,        # event_type outside the enumeration
    "text_cart": 79,       # cart_value sent as a JSON string
    "offset_time": 89,     # timestamp written with +00:00 instead of Z
    "resend": 10,          # producer re-sent the record one second later
    "padded_user": 7,      # user_id carries a trailing space
    "early_copy": 70,      # the re-send's record time is one second before the first's
    "late_copy": 90,       # sent a third time, two days later, to another partition
    "bad_time": 71,        # timestamp is not a time
    "bad_number": 73,      # cart_value sent as text that is no number
    "fraction": 61,        # quantity sent with a fraction
    "future": 67,          # event time three days after the record time
}
CDC_DEFECTS = {
    "bad_op": 103,         # op outside the enumeration
    "read": 59,            # op r (snapshot read)
    "no_image": 107,       # neither a before nor an after image
}
LATE_CHANGE = 53           # residue of changes stamped ten days before they arrive

# Mapping of the driver's event vocabulary onto the clickstream vocabulary.
TYPE_MAP = [("view", "page_view"), ("click", "add_to_cart"), ("purchase", "purchase"),
            ("error", "search")]
TYPE_OTHER = "user_login"
PAGE_BY_TYPE = [("page_view", "/item"), ("add_to_cart", "/basket"),
                ("purchase", "/pay"), ("search", "/find")]
PAGE_OTHER = "/home"
DEVICES = ["laptop", "phone", "kiosk"]
REFERRERS = ["newsletter", "partner", "qr-code", "none"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt to all cores.  A table of few large row groups is read by
    as few tasks, and so all that is derived from a row would run in them.  By
    a hash of the whole row, so a repeated or missing id fills no task; adaptive
    execution picks the number of tasks by the size."""
    return rows.repartition(*rows.columns)


def _sql_case(col: str, pairs: list[tuple[str, str]], other: str) -> str:
    whens = " ".join(f"WHEN '{src}' THEN '{dst}'" for src, dst in pairs)
    return f"CASE {col} {whens} ELSE '{other}' END"


def _sql_pick(index: str, values: list[str]) -> str:
    arr = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({arr}), CAST({index} % {len(values)} AS INT) + 1)"


# Feed columns are written as SQL expressions (one planner call per column)
# rather than built node by node from Python, which keeps the per-query
# set-up cost of these wide projections low.
K = "get_json_object(props, '$.k')"


def clickstream_events(events: DataFrame) -> DataFrame:
    """``events`` → clean clickstream records (typed, before JSON encoding)."""
    page_by_raw = [(src, dict(PAGE_BY_TYPE)[dst]) for src, dst in TYPE_MAP]
    product = "event_type IN ('view', 'click', 'purchase')"
    cart = "event_type IN ('click', 'purchase')"
    return events.selectExpr(
        "event_id AS event_num",
        "CAST(event_id AS STRING) AS event_id",
        "concat('USER-', lpad(CAST(user_id AS STRING), 6, '0')) AS user_id",
        "CAST(ts AS TIMESTAMP) AS ts",
        f"{_sql_case('event_type', TYPE_MAP, TYPE_OTHER)} AS event_type",
        f"CASE WHEN {product} THEN concat('PROD-', lpad({K}, 4, '0')) END AS product_id",
        "concat('s-', CAST(user_id AS STRING), '-', "
        "date_format(CAST(ts AS TIMESTAMP), 'yyyyMMdd')) AS session_id",
        f"{_sql_case('event_type', page_by_raw, PAGE_OTHER)} AS page_url",
        f"{_sql_pick('user_id', DEVICES)} AS device_type",
        f"{_sql_pick('event_id', REFERRERS)} AS referrer",
        f"CASE WHEN event_type = 'error' THEN concat('query-', {K}) END AS search_query",
        f"CASE WHEN {cart} THEN value END AS cart_value",
        f"CASE WHEN {cart} THEN CAST({K} AS INT) % 3 + 1 END AS quantity",
    )


def clickstream_messages(events: DataFrame, topic: str = TOPIC_CLICKSTREAM) -> DataFrame:
    """``events`` → Kafka-shaped records of clickstream JSON, with defects.

    Schema equals Spark's Kafka source: key, value BINARY; topic STRING;
    partition INT; offset BIGINT; timestamp TIMESTAMP; timestampType INT.
    Built in stages so that no large expression is repeated in the plan.
    """
    d = CLICK_DEFECTS
    has = {name: f"event_num % {r} = 0" for name, r in d.items()}
    ev = clickstream_events(events)
    # 1) the per-row fields as they are sent (defects applied)
    sent = ev.selectExpr(
        "event_num", "ts", "event_id", "product_id", "session_id",
        f"CASE WHEN {has['bad_time']} THEN 'some time ago' ELSE "
        f"concat(date_format(CASE WHEN {has['future']} THEN ts + INTERVAL 3 DAYS ELSE ts END, "
        "'yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSS'), "
        f"CASE WHEN {has['offset_time']} THEN '+00:00' ELSE 'Z' END) END AS `timestamp`",
        f"CASE WHEN {has['missing_user']} THEN CAST(NULL AS STRING) "
        f"WHEN {has['padded_user']} THEN concat(user_id, ' ') ELSE user_id END AS user_id",
        f"CASE WHEN {has['bad_type']} THEN 'bogus' ELSE event_type END AS event_type",
        "named_struct('page_url', page_url, 'device_type', device_type, 'referrer', referrer, "
        "'search_query', search_query, 'cart_value', cart_value, 'quantity', quantity) "
        "AS metadata",
    )
    # 2) JSON encoding (nulls omitted)
    encoded = sent.selectExpr(
        "event_num", "ts", "event_id", f"coalesce(user_id, '{UNKNOWN_KEY}') AS key",
        "to_json(named_struct('event_id', event_id, 'user_id', user_id, "
        "'timestamp', `timestamp`, 'event_type', event_type, 'product_id', product_id, "
        "'session_id', session_id, 'metadata', metadata)) AS body")
    # 3) encoding defects, re-sends, Kafka envelope
    return (
        encoded.selectExpr(
            "event_num", "ts", "key",
            f"CASE WHEN {has['malformed']} THEN concat('{{bad-', event_id) "
            f"WHEN {has['bad_number']} THEN regexp_replace(body, "
            "'\"cart_value\":([-0-9.Ee+]+)', '\"cart_value\":\"n/a\"') "
            f"WHEN {has['text_cart']} THEN regexp_replace(body, "
            "'\"cart_value\":([-0-9.Ee+]+)', '\"cart_value\":\"$1\"') "
            f"WHEN {has['fraction']} THEN regexp_replace(body, "
            "'\"quantity\":([0-9]+)', '\"quantity\":$1.7') "
            "ELSE body END AS value",
            f"explode(CASE WHEN {has['late_copy']} THEN array(0, 1, 2) "
            f"WHEN {has['resend']} THEN array(0, 1) ELSE array(0) END) AS copy")
        .selectExpr(
            "CAST(key AS BINARY) AS key",
            "CAST(value AS BINARY) AS value",
            f"'{topic}' AS topic",
            "CAST((event_num + CASE WHEN copy = 2 THEN 1 ELSE 0 END) % 3 AS INT) AS partition",
            "event_num * 4 + copy AS offset",
            "timestamp_micros(unix_micros(ts) + CASE WHEN copy = 0 THEN 0 "
            f"WHEN copy = 2 THEN 172800000000 WHEN {has['early_copy']} THEN -1000000 "
            "ELSE 1000000 END) AS timestamp",
            "0 AS timestampType",
        )
    )


def cdc_changes(events: DataFrame) -> DataFrame:
    """``events`` → typed user change records (op, ts_ms, source, before, after)."""
    uid = "concat('USER-', lpad(CAST(user_id AS STRING), 6, '0'))"
    c = CDC_DEFECTS
    staged = events.selectExpr(
        "event_id AS change_num",
        f"event_id % {c['no_image']} = 0 AS bare",
        f"CASE WHEN event_id % {c['bad_op']} = 0 THEN 'x' WHEN event_id % {c['read']} = 0 THEN 'r' "
        "WHEN event_type = 'signup' THEN 'c' WHEN event_type = 'error' THEN 'd' "
        "ELSE 'u' END AS op",
        f"unix_millis(CAST(ts AS TIMESTAMP)) - CASE WHEN event_id % {LATE_CHANGE} = 0 "
        "THEN 864000000 ELSE 0 END AS ts_ms",
        "unix_millis(CAST(ts AS TIMESTAMP)) AS arrived_ms",
        f"{uid} AS uid",
        "concat('user ', CAST(user_id AS STRING), ' v', CAST(event_id AS STRING)) AS name",
        "concat('u', CAST(event_id AS STRING), '@example.com') AS email")
    return staged.selectExpr(
        "change_num", "op", "ts_ms", "arrived_ms",
        "named_struct('table', 'users', 'db', 'ecommerce') AS source",
        "CASE WHEN op IN ('u', 'd', 'x') AND NOT bare THEN named_struct('user_id', uid, "
        "'name', CAST(NULL AS STRING), 'email', CAST(NULL AS STRING)) END AS before",
        "CASE WHEN op <> 'd' AND NOT bare THEN named_struct('user_id', uid, 'name', name, "
        "'email', email) END AS after")


def cdc_messages(events: DataFrame, topic: str = TOPIC_CDC) -> DataFrame:
    """``events`` → Kafka-shaped change-feed records (JSON keeps explicit nulls)."""
    return cdc_changes(events).selectExpr(
        f"CAST(coalesce(after.user_id, before.user_id, '{UNKNOWN_KEY}') AS BINARY) AS key",
        "CAST(to_json(named_struct('op', op, 'ts_ms', ts_ms, 'source', source, "
        "'before', before, 'after', after), map('ignoreNullFields', 'false')) AS BINARY) "
        "AS value",
        f"'{topic}' AS topic",
        "CAST(change_num % 3 AS INT) AS partition",
        "change_num AS offset",
        "timestamp_millis(arrived_ms) AS timestamp",
        "0 AS timestampType")


_PROFILE_EMAIL = "concat(lower(regexp_replace(c_name, '#', '.')), '@example.com')"


def profile_messages(customer: DataFrame) -> DataFrame:
    """``customer`` → user-profile JSON documents (one per customer).

    Customers with a negative balance lose their ``user_id`` key, which the
    profile rules reject.
    """
    return customer.selectExpr(
        "c_custkey AS profile_num",
        "to_json(named_struct("
        "'user_id', CASE WHEN c_acctbal >= 0 "
        "THEN concat('USER-', lpad(CAST(c_custkey AS STRING), 6, '0')) END, "
        f"'name', c_name, 'email', {_PROFILE_EMAIL}, "
        "'preferences', named_struct('segment', c_mktsegment, 'nation', c_nationkey))) AS value")


def user_profiles(customer: DataFrame) -> DataFrame:
    """``customer`` → typed user rows (user_id, name, email) for the dimension."""
    return customer.selectExpr(
        "concat('USER-', lpad(CAST(c_custkey AS STRING), 6, '0')) AS user_id",
        "c_name AS name",
        f"{_PROFILE_EMAIL} AS email")
