"""Kafka sources: option builders, stream and bounded readers, and the same
range semantics over a landed copy of a topic.

Reading Kafka needs the ``spark-sql-kafka`` connector on the cluster; the
option builders and ``replay_range`` (the bounded read expressed on a landed
table with Kafka's columns) work without it.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Schema of Spark's Kafka source (and of landed copies of a topic).
KAFKA_SCHEMA = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
    StructField("timestampType", IntegerType()),
])

EARLIEST, LATEST = -2, -1


Partitions = int | list[int] | dict[int, int | None]


def _partition_map(partitions: Partitions, value: int | None, default: int) -> dict[str, int]:
    """Every partition with its position: that of a dict if given there, else
    ``value``, else ``default``."""
    ids = range(partitions) if isinstance(partitions, int) else partitions
    own = partitions if isinstance(partitions, dict) else {}
    rest = default if value is None else int(value)
    return {str(p): rest if own.get(p) is None else int(own[p]) for p in ids}


def to_millis(ts: _dt.datetime) -> int:
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=_dt.timezone.utc)
    return int(ts.timestamp() * 1000)


def starting_options(topic: str, partitions: Partitions, offset: int | None = None,
                     timestamp: _dt.datetime | None = None) -> dict[str, str]:
    """Start position: an offset wins over a timestamp, else earliest.

    Offsets go to ``startingOffsets``; a time goes to
    ``startingOffsetsByTimestamp`` (milliseconds).  Spark wants every partition
    of the topic named, so ``partitions`` is required: their number, a list, or
    a dict with an offset (or, with ``timestamp``, None) per partition.
    """
    given = isinstance(partitions, dict) and any(v is not None for v in partitions.values())
    if offset is not None or given:
        return {"startingOffsets": json.dumps({topic: _partition_map(partitions, offset, EARLIEST)})}
    if timestamp is not None:
        ms = to_millis(timestamp)
        return {"startingOffsetsByTimestamp": json.dumps({topic: _partition_map(partitions, ms, ms)})}
    return {"startingOffsets": "earliest"}


def ending_options(topic: str, partitions: Partitions, end_offset: int | None = None) -> dict[str, str]:
    """End position (exclusive): the given offset on every partition (a dict:
    per partition), else latest."""
    given = isinstance(partitions, dict) and any(v is not None for v in partitions.values())
    if end_offset is None and not given:
        return {"endingOffsets": "latest"}
    return {"endingOffsets": json.dumps({topic: _partition_map(partitions, end_offset, LATEST)})}


CONNECTOR_HINT = ("the Kafka source needs the spark-sql-kafka-0-10 connector on the cluster "
                  "(for example --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark "
                  "version>)")


def _load(reader) -> DataFrame:
    try:
        return reader.load()
    except Exception as e:  # noqa: BLE001 — only the missing-connector case is rewrapped
        if "kafka" in str(e).lower() and "data source" in str(e).lower():
            raise RuntimeError(CONNECTOR_HINT) from e
        raise


def read_kafka_stream(spark: SparkSession, bootstrap: str, topic: str,
                      starting: str = "latest", fail_on_data_loss: bool = False,
                      extra: dict[str, str] | None = None) -> DataFrame:
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic)
         .option("startingOffsets", starting)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    return _load(r)


def read_kafka_batch(spark: SparkSession, bootstrap: str, topic: str,
                     starting: dict[str, str], ending: dict[str, str]) -> DataFrame:
    r = (spark.read.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic))
    for k, v in {**starting, **ending}.items():
        r = r.option(k, v)
    return _load(r)


def replay_range(landed: DataFrame, start_offset: int | dict[int, int] | None = None,
                 start_timestamp: _dt.datetime | None = None,
                 end_offset: int | dict[int, int] | None = None) -> DataFrame:
    """The records a bounded Kafka read would return, from a landed topic copy.

    Offset bounds are per partition (start inclusive, end exclusive).  A start
    time selects, per topic and partition, the first offset whose record
    timestamp is at or after it — later records are kept even if their
    timestamps are older, as Kafka does.  The starts are one row per topic
    partition; AQE broadcasts them by their measured size.
    """
    def bound(v, op):
        if not isinstance(v, dict):
            return op(F.col("offset"), F.lit(v))
        expr = F
        for p, o in v.items():
            expr = expr.when(F.col("partition") == p, op(F.col("offset"), F.lit(o)))
        return expr.otherwise(F.lit(True))

    out = landed
    if start_offset is not None:
        out = out.filter(bound(start_offset, lambda a, b: a >= b))
    elif start_timestamp is not None:
        ts = F.lit(start_timestamp).cast("timestamp")
        starts = (landed.filter(F.col("timestamp") >= ts)
                  .groupBy("topic", "partition").agg(F.min("offset").alias("__start")))
        out = (out.join(starts, ["topic", "partition"], "inner")
               .filter(F.col("offset") >= F.col("__start")).drop("__start"))
    if end_offset is not None:
        out = out.filter(bound(end_offset, lambda a, b: a < b))
    return out
