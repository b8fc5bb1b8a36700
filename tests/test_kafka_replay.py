"""Offsets (F9) and bounded-read semantics on a landed topic."""

import datetime as dt
import json

from tributary.sources import kafka as K


def test_offsets_default_and_values():
    assert K.starting_options("my-topic", 1) == {"startingOffsets": "earliest"}
    assert K.ending_options("my-topic", 1) == {"endingOffsets": "latest"}
    assert K.starting_options("my-topic", 1, offset=42) == {
        "startingOffsets": json.dumps({"my-topic": {"0": 42}})}
    assert K.starting_options("my-topic", 1, offset=42, timestamp=dt.datetime(2024, 6, 15)) == {
        "startingOffsets": json.dumps({"my-topic": {"0": 42}})}
    ts = dt.datetime(2024, 6, 15, 12, 0, tzinfo=dt.timezone.utc)
    assert K.starting_options("t", timestamp=ts, partitions=3) == {
        "startingOffsetsByTimestamp": json.dumps({"t": {"0": 1718452800000, "1": 1718452800000,
                                                        "2": 1718452800000}})}
    assert K.ending_options("t", end_offset=7, partitions=[0, 2]) == {
        "endingOffsets": json.dumps({"t": {"0": 7, "2": 7}})}
    # a dict: its own offsets, the given one for partitions without
    assert K.starting_options("t", {0: 5, 1: None}, offset=9) == {
        "startingOffsets": json.dumps({"t": {"0": 5, "1": 9}})}
    assert K.starting_options("t", {0: None, 1: None}, timestamp=ts) == {
        "startingOffsetsByTimestamp": json.dumps({"t": {"0": 1718452800000, "1": 1718452800000}})}


def test_replay_range(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", p, o, t0 + dt.timedelta(minutes=m)) for p, o, m in
            [(0, 0, 0), (0, 1, 10), (0, 2, 5), (0, 3, 20), (1, 0, 1), (1, 1, 2)]]
    landed = spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp timestamp")

    def got(**kw):
        return sorted((r.partition, r.offset) for r in K.replay_range(landed, **kw).collect())

    assert got(start_offset=1) == [(0, 1), (0, 2), (0, 3), (1, 1)]
    assert got(start_offset={0: 2}) == [(0, 2), (0, 3), (1, 0), (1, 1)]
    assert got(end_offset=1) == [(0, 0), (1, 0)]
    # first offset at/after the time per partition; later older records kept
    assert got(start_timestamp=t0 + dt.timedelta(minutes=8)) == [(0, 1), (0, 2), (0, 3)]
    # another topic on the same partition starts where its own records say
    other = spark.createDataFrame([("b", 0, 50, t0), ("b", 0, 51, t0 + dt.timedelta(hours=1))],
                                  landed.schema)
    late = K.replay_range(landed.unionByName(other), start_timestamp=t0 + dt.timedelta(minutes=8))
    assert sorted((r.topic, r.offset) for r in late.collect()) == [
        ("a", 1), ("a", 2), ("a", 3), ("b", 51)]


def test_kafka_readers_name_the_missing_connector(spark):
    import pytest

    try:
        K.read_kafka_stream(spark, "broker:9092", "t")
    except RuntimeError as e:
        assert "spark-sql-kafka" in str(e)
    else:  # a connector is installed: the reader is lazy and returns a stream
        pass
    with pytest.raises(Exception):
        K.read_kafka_batch(spark, "broker:9092", "t", K.starting_options("t", 3),
                           K.ending_options("t", 3)).count()
