"""Streams: bronze restart adds no rows; silver dedups across batches;
gold drops late rows and reports them."""

import datetime as dt
import json

from tributary.sources.kafka import KAFKA_SCHEMA
from tributary.streaming import jobs as J

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def event(eid, minute, etype="page_view"):
    return json.dumps({"event_id": eid, "user_id": "U1", "timestamp":
                       (T0 + dt.timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%S.%fZ"),
                       "event_type": etype, "session_id": "s1", "product_id": "p1",
                       "metadata": {}})


def land(spark, path, rows):
    recs = [(b"k", v.encode(), "t", 0, off, T0 + dt.timedelta(minutes=m), 0)
            for off, (v, m) in enumerate(rows)]
    spark.createDataFrame(recs, KAFKA_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_bronze_restart_and_silver_dedup(spark, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path)
    land(spark, landed, [(event("e1", 0), 0), (event("e2", 1), 1)])
    for _ in range(2):  # second run on the same checkpoint must add nothing
        J.start_bronze(J.landed_stream(spark, landed), f"{root}/bronze", f"{root}/chk/b",
                       trigger={"availableNow": True}).awaitTermination()
    assert spark.read.parquet(f"{root}/bronze").count() == 2
    like = spark.read.parquet(f"{root}/bronze")
    J.start_silver(J.table_stream(spark, f"{root}/bronze", like), f"{root}/silver",
                   f"{root}/chk/s", trigger={"availableNow": True}).awaitTermination()
    # a re-sent e1 arrives in a later batch and must not reach silver again
    land(spark, landed, [(event("e1", 0), 3), (event("e3", 2), 3)])
    J.start_bronze(J.landed_stream(spark, landed), f"{root}/bronze", f"{root}/chk/b",
                   trigger={"availableNow": True}).awaitTermination()
    J.start_silver(J.table_stream(spark, f"{root}/bronze", like), f"{root}/silver",
                   f"{root}/chk/s", trigger={"availableNow": True}).awaitTermination()
    silver = spark.read.parquet(f"{root}/silver")
    assert sorted(r.event_id for r in silver.collect()) == ["e1", "e2", "e3"]
    assert silver.select("batch_id").distinct().count() == 2


def test_gold_late_rows_dropped(spark, tmp_path):
    root = str(tmp_path)
    schema = ("event_id string, user_id string, event_timestamp timestamp, event_type string, "
              "product_id string, session_id string, cart_value double")
    src = f"{root}/silver"
    like = spark.createDataFrame([], schema)

    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        q = J.start_gold(J.table_stream(spark, src, like, max_files_per_trigger=1),
                         "events_per_minute", f"{root}/gold", f"{root}/chk/g",
                         trigger={"availableNow": True})
        q.awaitTermination()
        return q

    add([("a", "u", T0 + dt.timedelta(minutes=30), "page_view", "p", "s", None)])
    run()
    add([("c", "u", T0 + dt.timedelta(minutes=60), "page_view", "p", "s", None)])
    run()   # closes the window of "a"
    add([("b", "u", T0, "page_view", "p", "s", None)])  # 30 minutes late: beyond 2 minutes
    q = run()
    assert J.rows_dropped_by_watermark(q) >= 1
    out = spark.read.parquet(f"{root}/gold")
    assert [r.window_start for r in out.collect()] == [T0 + dt.timedelta(minutes=30)]


def layers(spark, root):
    """Bronze and silver over all that has landed, as far as it is new."""
    J.start_bronze(J.landed_stream(spark, f"{root}/landed"), f"{root}/bronze", f"{root}/chk/b",
                   trigger={"availableNow": True}).awaitTermination()
    like = spark.read.parquet(f"{root}/bronze")
    J.start_silver(J.table_stream(spark, f"{root}/bronze", like), f"{root}/silver",
                   f"{root}/chk/s", trigger={"availableNow": True}).awaitTermination()


def test_copy_days_later_stays_out(spark, tmp_path):
    root = str(tmp_path)
    land(spark, f"{root}/landed", [(event("e1", 0), 0)])
    layers(spark, root)
    land(spark, f"{root}/landed", [(event("e1", 0), 60 * 24 * 9), (event("e2", 1), 60 * 24 * 9)])
    layers(spark, root)
    assert sorted(r.event_id for r in spark.read.parquet(f"{root}/silver").collect()) == ["e1", "e2"]


def test_merged_ids_still_keep_copies_out(spark, tmp_path):
    root = str(tmp_path)
    for day in range(3):
        land(spark, f"{root}/landed", [(event(f"e{day}", day), 60 * 24 * day)])
        layers(spark, root)
    assert J.compact_ids(spark, f"{root}/silver", 1) == 2 and J.compact_ids(spark, f"{root}/silver", 1) == 0
    land(spark, f"{root}/landed", [(event("e0", 0), 9999), (event("e2", 2), 9999), (event("e9", 3), 9999)])
    layers(spark, root)
    assert J.compact_ids(spark, f"{root}/silver", 3) == 3
    assert sorted(r.event_id for r in spark.read.parquet(f"{root}/silver").collect()) == ["e0", "e1", "e2", "e9"]
    assert spark.read.parquet(J.ids_path(f"{root}/silver")).count() == 4


def test_repeated_silver_batch_counts_once(spark, tmp_path):
    root = str(tmp_path)
    land(spark, f"{root}/landed", [(event("e1", 0), 0), (event("e2", 60), 1)])
    layers(spark, root)
    like = spark.read.parquet(f"{root}/silver")

    def gold():
        J.start_gold(J.table_stream(spark, f"{root}/silver", like), "events_per_minute",
                     f"{root}/gold", f"{root}/chk/g", trigger={"availableNow": True}).awaitTermination()

    gold()
    before = sorted(r.path for r in spark.read.format("binaryFile").load(f"{root}/silver/batch_id=0/*.parquet")
                    .select("path").collect())
    J.silver_batch_writer(spark, f"{root}/silver")(spark.read.parquet(f"{root}/bronze"), 0)
    after = sorted(r.path for r in spark.read.format("binaryFile").load(f"{root}/silver/batch_id=0/*.parquet")
                   .select("path").collect())
    assert before == after
    gold()
    out = spark.read.parquet(f"{root}/gold")
    assert [(r.window_start, r.event_count) for r in out.collect()] == [(T0, 1)]


def test_handler_and_stream_share_snapshot_numbers(spark, tmp_path):
    from tributary.api import CDCHandler

    schema = ("op string, ts_ms bigint, seq bigint, before struct<user_id:string,name:string,"
              "email:string>, after struct<user_id:string,name:string,email:string>")
    ms = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)

    def change(i, user):
        return spark.createDataFrame([("c", ms + i, i, None, (user, user, user))], schema)

    handler = CDCHandler(spark, str(tmp_path / "dim"))
    handler.initialize_dimension_table(
        spark.createDataFrame([("u0", "A", "a")], "user_id string, name string, email string"), now=T0)
    handler.apply_cdc_batch(change(1, "u1"))
    handler.apply_cdc_batch(change(2, "u2"))
    write = J.scd2_batch_writer(spark, handler.path)
    write(change(3, "u3"), 0)
    write(change(3, "u3"), 0)      # the same batch again changes nothing
    assert sorted(r.user_id for r in handler.read().collect()) == ["u0", "u1", "u2", "u3"]
    assert J.latest_snapshot(spark, handler.path).endswith("snapshot=3")
    (tmp_path / "dim" / "snapshot=9").mkdir()      # not complete: no _SUCCESS
    assert J.latest_snapshot(spark, handler.path).endswith("snapshot=3")
    assert J.expire_snapshots(spark, handler.path, keep=2) == 2 and handler.read().count() == 4


def test_router_stream_and_observed_metrics(spark, tmp_path):
    from tributary.fixed import CLICKSTREAM_SCHEMA
    from tributary.operators import routing as R

    landed = str(tmp_path / "raw")
    good, bad = event("e1", 0), json.dumps({"event_id": "e2"})
    land(spark, landed, [(good, 0), (bad, 1), ("{oops", 2)])
    raw = J.landed_stream(spark, landed)
    q = J.start_router(R.observed_routes(R.validate(raw, CLICKSTREAM_SCHEMA)).drop(
                           "errors", "error", "route"),
                       CLICKSTREAM_SCHEMA, "clickstream-events", str(tmp_path / "ok"),
                       str(tmp_path / "dlq"), str(tmp_path / "chk"),
                       trigger={"availableNow": True})
    q.awaitTermination()
    ok = spark.read.parquet(str(tmp_path / "ok")).collect()
    dlq = spark.read.parquet(str(tmp_path / "dlq")).collect()
    assert [r.key for r in ok] == ["U1"] and len(dlq) == 2
    assert sorted(r.error for r in dlq) == ["'user_id' is a required property", "malformed"]
    progress = [json.loads(p.json) for p in q.recentProgress]
    seen = [p["observedMetrics"]["routes"] for p in progress if p.get("observedMetrics")]
    assert seen and seen[0]["sent"] == 1 and seen[0]["dlq"] == 2


def test_scd2_stream_snapshots(spark, tmp_path):
    from tributary.operators import scd2 as C

    root = str(tmp_path / "dim")
    users = spark.createDataFrame([("u1", "A", "a@x")], "user_id string, name string, email string")
    C.initialize_dimension(users, now=T0).write.parquet(f"{root}/snapshot=0")
    schema = ("op string, ts_ms bigint, seq bigint, before struct<user_id:string,name:string,"
              "email:string>, after struct<user_id:string,name:string,email:string>")
    feed = str(tmp_path / "cdc")
    ms = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    spark.createDataFrame([("u", ms + 1000, 1, ("u1", None, None), ("u1", "B", "b@x"))],
                          schema).coalesce(1).write.parquet(feed)
    spark.createDataFrame([("c", ms + 2000, 2, None, ("u2", "C", "c@x"))],
                          schema).coalesce(1).write.mode("append").parquet(feed)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed)
    J.start_scd2(stream, root, str(tmp_path / "chk"), trigger={"availableNow": True}) \
        .awaitTermination()
    latest = J.latest_snapshot(spark, root)
    assert latest is not None and not latest.endswith("snapshot=0")
    rows = sorted((r.user_id, r.version, r.is_current)
                  for r in spark.read.parquet(latest).collect())
    assert rows == [("u1", 1, False), ("u1", 2, True), ("u2", 1, True)]
