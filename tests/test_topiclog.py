"""A landed topic with an index: ranges, times, files opened, restart, loss."""

import datetime as dt

import pytest

from tributary.sources import kafka as K
from tributary.sources import topiclog as T

T0 = dt.datetime(2024, 1, 1)


def records(spark, rows):
    """(topic, partition, offset, minute)"""
    return spark.createDataFrame(
        [(b"k", b'{"event_id": "%d"}' % o, t, p, o, T0 + dt.timedelta(minutes=m), 0) for t, p, o, m in rows],
        K.KAFKA_SCHEMA)


@pytest.fixture
def log(spark, tmp_path):
    """Two topics; times go up but for a stray one; offsets have gaps."""
    rows = [("a", p, o, o // 2 if o % 50 else o + 300) for p in (0, 1) for o in range(0, 400, 2)]
    rows += [("b", 0, o, o + 1000) for o in range(100)]
    T.append(records(spark, rows), str(tmp_path), "one", files=10)
    T.append(records(spark, [("a", 0, o, o) for o in range(400, 440)]), str(tmp_path), "two", files=2)
    return str(tmp_path)


def landed(spark, log):
    return spark.read.schema(K.KAFKA_SCHEMA).parquet(f"{log}/data/one", f"{log}/data/two")


def places(df):
    return sorted((r.topic, r.partition, r.offset) for r in df.select("topic", "partition", "offset").collect())


@pytest.mark.parametrize("kw", [{}, {"start_offset": 101}, {"start_offset": 390, "end_offset": 405},
                                {"start_timestamp": T0 + dt.timedelta(minutes=150)},
                                {"start_timestamp": T0 + dt.timedelta(minutes=1010)},
                                {"start_timestamp": T0 + dt.timedelta(days=99)},
                                {"end_offset": 7}, {"start_offset": 5000}])
def test_replay_equals_the_rules_of_a_topic(spark, log, kw):
    assert places(T.replay(spark, log, **kw)) == places(K.replay_range(landed(spark, log), **kw))


def test_offsets_per_partition(spark, log):
    got = T.replay(spark, log, start_offset={("a", 1): 396, ("b", 0): 98, ("a", 0): 436},
                   end_offset={("a", 0): 438})
    assert places(got) == [("a", 0, 436), ("a", 0, 437), ("a", 1, 396), ("a", 1, 398), ("b", 0, 98), ("b", 0, 99)]


def test_only_files_that_hold_the_range_are_opened(spark, log):
    every = set(landed(spark, log).inputFiles())
    few = set(T.replay(spark, log, start_offset={("a", 0): 430, ("a", 1): 10 ** 6, ("b", 0): 10 ** 6}).inputFiles())
    assert len(every) == 12 and len(few) == 1 and few < every
    late = set(T.replay(spark, log, start_timestamp=T0 + dt.timedelta(minutes=1050)).inputFiles())
    assert 0 < len(late) < len(every) / 2
    plan = T.replay(spark, log, start_offset=101)._jdf.queryExecution().executedPlan().toString()
    assert "offset" in plan.split("PushedFilters: ")[1].split("]")[0]


def test_a_batch_lands_once(spark, log):
    assert T.append(records(spark, [("a", 0, 999, 0)]), log, "two") is False
    assert T.bounds(spark, log).end == {("a", 0): 440, ("a", 1): 399, ("b", 0): 100}
    assert T.bounds(spark, f"{log}/none").end == {}
    assert T.replay(spark, f"{log}/none").count() == 0


def test_stream_goes_on_at_the_stored_offsets(spark, log):
    table = f"{log}/bronze"
    assert T.run_bronze(spark, log, table, max_offsets=200, max_batches=2) == 2
    batch, offsets = T.committed(spark, table)
    assert batch == 1 and sum(offsets.values()) <= 400
    first = spark.read.parquet(table).count()
    assert 0 < first <= 400
    # a record of a new partition lands between two runs
    T.append(records(spark, [("c", 0, 5, 0)]), log, "three")
    assert T.run_bronze(spark, log, table, max_offsets=300) >= 2
    rows = spark.read.parquet(table)
    assert rows.count() == landed(spark, log).count() + 1
    assert rows.select("kafka_partition", "kafka_offset", "event_id").distinct().count() <= rows.count()
    sizes = [r["count"] for r in rows.groupBy("batch_id").count().collect()]
    assert max(sizes) <= 300
    assert T.run_bronze(spark, log, table) == 0         # nothing waits
    assert T.committed(spark, table)[1] == T.bounds(spark, log).end


def test_a_failed_batch_leaves_nothing(spark, log, monkeypatch):
    table = f"{log}/bronze"
    real = T.publish

    def broken(df, root, name, **kw):
        df.write.parquet(f"{root}/_staging/half")
        raise OSError("lost")

    monkeypatch.setattr(T, "publish", broken)
    with pytest.raises(OSError):
        T.run_bronze(spark, log, table)
    monkeypatch.setattr(T, "publish", real)
    assert T.committed(spark, table) == (-1, None)
    T.run_bronze(spark, log, table)
    assert spark.read.parquet(table).count() == landed(spark, log).count()


def test_records_that_are_gone(spark, log):
    table = f"{log}/bronze"
    T.run_bronze(spark, log, table, starting={("a", 0): 410, ("a", 1): 398, ("b", 0): 99}, max_offsets=12)
    T.append(records(spark, [("a", 0, o, o) for o in range(500, 510)]), log, "three")
    T.expire(spark, log, "two")
    T.expire(spark, log, "one")
    assert T.committed(spark, table)[1][("a", 0)] <= 440
    with pytest.raises(T.DataLoss):
        T.run_bronze(spark, log, table, fail_on_data_loss=True)
    assert T.run_bronze(spark, log, table) == 1
    kept = spark.read.parquet(table)
    assert kept.where("kafka_offset >= 500").count() == 10
    # partitions without records keep their place
    assert T.committed(spark, table)[1][("b", 0)] == 100
    with pytest.raises(T.DataLoss):
        T.replay(spark, log, start_offset={("a", 0): 3}, fail_on_data_loss=True)


def test_rate_is_shared_by_what_waits():
    start, end = {("t", 0): 0, ("t", 1): 0, ("t", 2): 5}, {("t", 0): 900, ("t", 1): 100, ("t", 2): 5}
    assert T._limited(start, end, None) == end and T._limited(start, end, 1000) == end
    assert T._limited(start, end, 100) == {("t", 0): 90, ("t", 1): 10, ("t", 2): 5}
    assert T._limited(start, end, 1) == {("t", 0): 1, ("t", 1): 1, ("t", 2): 5}
