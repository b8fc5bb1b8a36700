"""Late rows beside a gold stream, gold refreshed window by window, distinct
counts rolled up from sketches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tributary.operators import gold as G
from tributary.operators import rollups as RU
from tributary.plans import refresh as RF
from tributary.streaming import jobs as J
from tributary.streaming import late as L

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
SILVER = ("event_id string, user_id string, event_timestamp timestamp, event_type string, product_id string, "
          "session_id string, cart_value double")
NOW = {"availableNow": True}


def rows(spark, minutes, first=0, **more):
    """An event at each minute (None: without a time)."""
    def one(i, m):
        return (f"e{first + i}", more.get("user", f"u{i % 7}"),
                None if m is None else T0 + dt.timedelta(minutes=m), ["page_view", "purchase"][i % 2],
                None if i % 5 == 4 else f"p{i % 3}", f"s{i % 4}", float(i) if i % 2 else None)
    return spark.createDataFrame([one(i, m) for i, m in enumerate(minutes)], SILVER)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- late rows

def run(spark, root, batches, table="events_per_minute"):
    like = rows(spark, [])
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(f"{root}/silver")
        L.start_late_split(J.table_stream(spark, f"{root}/silver", like), table, f"{root}/ontime", f"{root}/late",
                           f"{root}/chk/split", trigger=NOW).awaitTermination()
        q = J.start_gold(J.table_stream(spark, f"{root}/ontime", like), table, f"{root}/gold", f"{root}/chk/gold",
                         trigger=NOW)
        q.awaitTermination()
    return q


@pytest.mark.parametrize("table,total", [("events_per_minute", "event_count"), ("conversion_rate", "total_events"),
                                         ("active_users_hourly", "total_events")])
def test_gold_and_late_are_all_rows(spark, tmp_path, table, total):
    totals = L.ProgressTotals()
    spark.streams.addListener(totals)
    try:
        batches = [rows(spark, [0, 1, 2, 200, None]), rows(spark, [3, 199, 198, 201, 150], 10),
                   rows(spark, [None, 0, 500], 20), rows(spark, [100, 499, 498, 497], 30),
                   rows(spark, [100_000], 40)]      # the last closes every window before it
        q = run(spark, str(tmp_path), batches, table)
        everything = spark.read.parquet(f"{tmp_path}/silver").count()
        late = spark.read.parquet(f"{tmp_path}/late")
        gold = spark.read.parquet(f"{tmp_path}/gold").agg(F.sum(total)).first()[0]
        assert gold + late.count() + 1 == everything        # one row's window is open still
        assert {r.reason for r in late.select("reason").distinct().collect()} == {L.LATE, L.UNTIMED}
        assert late.where("event_timestamp is null").count() == 2
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
        seen = totals.of(q)
        assert seen["dropped"] == 0 and seen["batches"] >= 5
        assert seen["rows"] == everything - late.count()
    finally:
        spark.streams.removeListener(totals)


def test_watermark_comes_from_earlier_batches_only(spark, tmp_path):
    """Rows of one batch are never late against each other; a repeated batch
    changes nothing."""
    write = L.late_batch_writer(spark, "events_per_minute", f"{tmp_path}/ontime", f"{tmp_path}/late")
    first, second = rows(spark, [60, 0]), rows(spark, [10, 57.5, 58.5], 5)
    write(first, 0)
    write(second, 1)
    write(rows(spark, [1, 2, 3]), 1)            # batch 1 again, however it looks
    late = spark.read.parquet(f"{tmp_path}/late").collect()
    # newest 13:00, two minutes allowed: windows that end by 12:58 are closed
    mark = T0 + dt.timedelta(minutes=58)
    assert sorted((r.event_id, r.watermark) for r in late) == [("e5", mark), ("e6", mark)]
    assert spark.read.parquet(f"{tmp_path}/ontime").count() == 3
    write(rows(spark, []), 2)                   # an empty batch keeps the mark
    assert L.newest_time(spark, f"{tmp_path}/ontime", 3) == L.newest_time(spark, f"{tmp_path}/ontime", 1)


def test_progress_is_never_forgotten(spark, tmp_path):
    """More batches than a query remembers itself (100)."""
    totals = L.ProgressTotals()
    spark.streams.addListener(totals)
    try:
        src = f"{tmp_path}/src"
        spark.range(105).repartition(105).write.parquet(src)
        q = (spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src).writeStream
             .format("noop").option("checkpointLocation", f"{tmp_path}/chk").trigger(**NOW).start())
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
        assert totals.of(q)["rows"] == 105 and len(q.recentProgress) <= 100
    finally:
        spark.streams.removeListener(totals)


# --- refreshed gold

def gold_files(spark, path):
    return {f for f in spark.read.parquet(path).inputFiles()}


def day_of(file):
    return file.split("/day=")[1].split("/")[0]


@pytest.mark.parametrize("table", sorted(RF.WINDOWS))
def test_refresh_equals_full_computation(spark, tmp_path, table):
    minutes = [d * 1440 + m for d in range(5) for m in (0, 3, 64, 700, 719, 721)]
    RF.append_silver(rows(spark, [*minutes, None]), f"{tmp_path}/silver")
    RF.store_gold(spark.read.parquet(f"{tmp_path}/silver"), table, f"{tmp_path}/gold", "exact")
    before = gold_files(spark, f"{tmp_path}/gold")
    # noon of the 3rd: sliding windows of the evening only; one row after midnight of the 5th
    late = rows(spark, [2 * 1440 + 2, 2 * 1440 + 2, 4 * 1440 + 725, None], 500)
    RF.append_silver(late, f"{tmp_path}/silver")
    days = RF.refresh_gold(spark, table, f"{tmp_path}/silver", late, f"{tmp_path}/gold", "exact")
    after = gold_files(spark, f"{tmp_path}/gold")

    def full():
        kwargs = {} if table == "popular_products" else {"distinct": "exact"}
        return plain(G.GOLD_TABLES[table](spark.read.parquet(f"{tmp_path}/silver").drop("event_date"),
                                          watermark=None, **kwargs))

    assert plain(RF.read_gold(spark, f"{tmp_path}/gold")) == full()
    changed = {str(d) for d in days}
    assert {day_of(f) for f in after - before} == changed and len(changed) < len({day_of(f) for f in after})
    assert {f for f in before if day_of(f) not in changed} <= after
    # again: the same
    RF.refresh_gold(spark, table, f"{tmp_path}/silver", late, f"{tmp_path}/gold", "exact")
    assert plain(RF.read_gold(spark, f"{tmp_path}/gold")) == full()


def test_only_touched_windows_are_computed(spark):
    got = RF.touched_windows(rows(spark, [0, 1, None]), "conversion_rate").collect()
    assert [r.start for r in got] == [T0]
    got = RF.touched_windows(rows(spark, [0]), "popular_products").collect()
    assert sorted(r.start for r in got) == [T0 - dt.timedelta(minutes=m) for m in range(55, -1, -5)]
    no_product = rows(spark, [0, 0, 0, 0, 600]).where("product_id is null")
    assert RF.touched_windows(no_product, "popular_products").count() == 0


def test_refresh_without_timed_rows(spark, tmp_path):
    RF.append_silver(rows(spark, [0]), f"{tmp_path}/silver")
    RF.store_gold(rows(spark, [0]), "conversion_rate", f"{tmp_path}/gold")
    before = gold_files(spark, f"{tmp_path}/gold")
    assert RF.refresh_gold(spark, "conversion_rate", f"{tmp_path}/silver", rows(spark, [None]),
                           f"{tmp_path}/gold") == []
    assert gold_files(spark, f"{tmp_path}/gold") == before


# --- rolled-up distinct counts

def test_rollups_of_many_users(spark):
    n = 60_000
    silver = spark.range(n).select(
        F.concat(F.lit("e"), "id").alias("event_id"), F.concat(F.lit("u"), F.col("id") % 20_000).alias("user_id"),
        (F.lit(T0).cast("timestamp") + F.make_interval(secs=F.col("id") % 7200)).alias("event_timestamp"),
        F.when(F.col("id") % 3 == 0, "purchase").otherwise("page_view").alias("event_type"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("s"), F.col("id") % 30_000)).alias("session_id"),
        F.when(F.col("id") % 3 == 0, F.col("id").cast("double")).alias("cart_value"))
    minutes = RU.minute_sketches(silver)
    for every, windows in (("5 minutes", 24), ("1 hour", 2), ("1 day", 1)):
        rolled = {r.window_start: r for r in RU.rollup(minutes, every).collect()}
        exact = silver.groupBy(F.window("event_timestamp", every).start.alias("w")).agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"),
            F.count_distinct("session_id").alias("sessions"), F.avg("cart_value").alias("mean"),
            F.count_if(F.col("event_type") == "purchase").alias("purchases")).collect()
        assert len(rolled) == len(exact) == windows
        for e in exact:
            r = rolled[e.w]
            assert (r.events, r.purchases, r.avg_cart_value) == (e.n, e.purchases, pytest.approx(e.mean))
            for got, want in ((r.users, e.users), (r.sessions, e.sessions)):
                assert abs(got - want) <= max(1, 5 * RU.RELATIVE_ERROR * want)
    one = {r.window_start: r for r in RU.one_pass(silver, "1 hour").collect()}
    for r in RU.rollup(minutes, "1 hour").collect():
        # merged and direct sketches estimate alike, but for the order of insertion
        assert abs(r.users - one[r.window_start].users) <= 5 * RU.RELATIVE_ERROR * r.users


def test_batches_merge_and_repeat_once(spark, tmp_path):
    write = RU.minute_batch_writer(f"{tmp_path}/m")
    a, b = rows(spark, [0, 1, 1, 61, None]), rows(spark, [0, 1, 62], 3, user="u9")
    write(a, 0)
    write(b, 1)
    write(b, 1)
    whole = RU.minute_sketches(a.unionAll(b))
    stored = spark.read.parquet(f"{tmp_path}/m").drop("batch_id")
    want = plain(RU.rollup(whole, "1 hour"))
    assert plain(RU.rollup(stored, "1 hour")) == want
    assert plain(RU.rollup(RU.merge_minutes(spark, f"{tmp_path}/m"), "1 hour")) == want
    assert plain(RU.rollup(whole, "1 hour", by_type=True)) == plain(RU.rollup(stored, "1 hour", by_type=True))
    assert sum(r.events for r in RU.rollup(stored, "1 hour").collect()) == 7


def test_rollup_of_nothing_and_nulls(spark):
    assert RU.rollup(RU.minute_sketches(rows(spark, [None])), "1 hour").count() == 0
    nobody = rows(spark, [0, 1]).withColumns({"user_id": F.lit(None).cast("string"),
                                              "session_id": F.lit(None).cast("string"),
                                              "cart_value": F.lit(None).cast("double")})
    r = RU.rollup(RU.minute_sketches(nobody), "1 hour").first()
    assert (r.events, r.users, r.sessions, r.avg_cart_value, r.conversion_rate) == (2, 0, 0, None, 0.0)
