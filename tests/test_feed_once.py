"""Input dealt to all cores, and feeds that are taken in parts derived once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tributary.plans import catalog as CAT
from tributary.plans import catalog_state as CS
from tributary.sources import feeds


class Stop(Exception):
    """Ends a query where its first part is handed on."""


def tables(spark, root):
    """Events and customers as the driver's tables have them."""
    kinds = ["view", "click", "purchase", "error", "signup"]
    spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=3 * i), i % 7, kinds[i % 5], 1.5 * i, '{"k": %d}' % i)
         for i in range(200)], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
                               "props string").coalesce(1).write.parquet(f"{root}/events.parquet")
    spark.createDataFrame([(i, f"Customer#{i}", 1, 1.0, "A") for i in range(9)],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
                          ).write.parquet(f"{root}/customer.parquet")
    return str(root)


def derived(df):
    """True where reading ``df`` makes the feed from the events (again)."""
    return any("events.parquet" in path for path in df.inputFiles())


def handed_on(monkeypatch, spark, sf_dir, query, owner, name, pick):
    seen = []

    def stop(*args, **kw):
        seen.append(pick(*args, **kw))
        raise Stop

    monkeypatch.setattr(owner, name, stop)
    with pytest.raises(Stop):
        query(spark, sf_dir)
    return seen[0]


def test_one_row_group_is_dealt_to_several_tasks(spark, tmp_path):
    # one file, one row group, no ids
    rows = spark.range(400_000).select(F.lit(None).cast("long").alias("event_id"),
                                       F.xxhash64("id").alias("user_id"), F.md5(F.col("id").cast("string")).alias("props"))
    rows.coalesce(1).write.option("parquet.block.size", 1 << 30).parquet(f"{tmp_path}/events.parquet")
    got = CAT.events(spark, str(tmp_path)).withColumn("task", F.spark_partition_id())
    counts = [r["count"] for r in got.groupBy("task").count().collect()]
    assert sum(counts) == 400_000 and len(counts) > 1 and max(counts) < 300_000
    assert feeds.spread(spark.range(0).toDF("event_id")).count() == 0


def test_stream_layers_take_their_parts_from_a_stored_topic(spark, tmp_path, monkeypatch):
    sf_dir = tables(spark, tmp_path)
    assert derived(CAT.click_messages(spark, sf_dir))
    topic = handed_on(monkeypatch, spark, sf_dir, CAT._make_stream_layers, CAT, "_land_topic", lambda *a: a[0])
    assert not derived(topic)
    assert sorted(topic.collect()) == sorted(CAT.click_messages(spark, sf_dir).collect())


def test_scd2_bucketed_takes_its_parts_from_a_stored_feed(spark, tmp_path, monkeypatch):
    sf_dir = tables(spark, tmp_path)
    part = handed_on(monkeypatch, spark, sf_dir, CS.q_scd2_bucketed, CS.D, "apply_batch", lambda *a, **kw: a[2])
    assert not derived(part) and part.count() > 0


def test_schema_drift_takes_its_parts_from_a_stored_feed(spark, tmp_path, monkeypatch):
    sf_dir = tables(spark, tmp_path)

    def write(batch, batch_id):
        assert not derived(batch) and batch.count() > 0
        raise Stop

    monkeypatch.setattr(CS.DR, "drift_batch_writer", lambda *a, **kw: write)
    with pytest.raises(Stop):
        CS.q_schema_drift(spark, sf_dir)


def test_stream_dedup_pruned_takes_its_parts_from_stored_rows(spark, tmp_path, monkeypatch):
    sf_dir = tables(spark, tmp_path)
    like = handed_on(monkeypatch, spark, sf_dir, CS.q_stream_dedup_pruned, CS.J, "table_stream",
                     lambda *a, **kw: a[2])
    assert not derived(like)
    assert sorted(map(str, like.collect())) == sorted(map(str, CAT.bronze(spark, sf_dir).collect()))
