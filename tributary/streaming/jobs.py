"""Streaming jobs: bronze (append file sink), silver (foreachBatch with
idempotent per-batch output), gold (windowed aggregates with watermarks).

Layers hand over through tables, because one streaming plan may carry only
one watermark: bronze and silver are keyed on Kafka time, gold on event time.

Exactly-once: the bronze file sink commits through its ``_spark_metadata``
log; silver, the router and the dimension publish each micro-batch as one
folder, complete and once (``sources.tables.publish``), so a batch that Spark
repeats changes nothing that a later layer may have read; gold uses the append
file sink, which emits a window once the watermark passes its end (late rows
are dropped and counted in the query progress).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.operators import gold as G
from tributary.operators import routing as R
from tributary.operators import scd2 as C
from tributary.operators import silver as S
from tributary.operators.bronze import process_bronze
from tributary.sources.kafka import KAFKA_SCHEMA, read_kafka_stream
from tributary.sources.tables import note, publish, put_note
from tributary.streaming import idtable as I

BATCH_COL = "batch_id"


def _start(writer, trigger: dict | None, path: str | None = None) -> StreamingQuery:
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start(path) if path else writer.start()


# --- sources -----------------------------------------------------------------

def landed_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                  fmt: str = "parquet") -> DataFrame:
    """A stream of Kafka-shaped records from files landed in ``path``
    (stand-in for the Kafka source where no broker is reachable)."""
    r = spark.readStream.schema(KAFKA_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def table_stream(spark: SparkSession, path: str, like: DataFrame | None = None,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """New files of a table as a stream (schema from ``like`` or the table)."""
    schema = (like if like is not None else spark.read.format(fmt).load(path)).schema
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


# --- bronze ------------------------------------------------------------------

def start_bronze(source: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet",
                 trigger: dict | None = None) -> StreamingQuery:
    """Raw records → bronze rows, appended; one narrow stage per micro-batch.
    Fields that the schema does not name: ``operators.drift`` keeps them."""
    w = (process_bronze(source).writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint))
    return _start(w, trigger, out_path)


def run_bronze_from_kafka(spark: SparkSession, bootstrap: str, topic: str, bronze_path: str,
                          checkpoint_root: str, fmt: str = "parquet",
                          trigger: dict | None = None) -> StreamingQuery:
    """Kafka topic → bronze table, checkpointed under ``<root>/bronze``
    (latest offsets on first start, tolerant of expired offsets)."""
    source = read_kafka_stream(spark, bootstrap, topic, starting="latest",
                               fail_on_data_loss=False)
    return start_bronze(source, bronze_path, f"{checkpoint_root}/bronze", fmt, trigger)


# --- routing -----------------------------------------------------------------

def router_batch_writer(schema: dict, topic: str, accepted_path: str, dlq_path: str,
                        key: Callable[[DataFrame], DataFrame] | None = None,
                        fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """foreachBatch body: validate once, write accepted (keyed) and dead
    letters from the same persisted batch, each published as a batch folder
    (a repeated batch id changes nothing).  ``accepted_path`` and ``dlq_path``
    are table folders; ``fmt="kafka"`` needs ``kafka_batch_writer``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        checked = R.validate(batch, schema, key=None if key else "clickstream").persist()
        try:
            ok = R.accepted(checked)
            ok = key(ok) if key else ok.withColumn("key", F.col("route_key"))
            publish(ok.select("key", F.col("value").cast("string").alias("value"),
                              F.lit(topic).alias("topic")),
                    accepted_path, f"{BATCH_COL}={batch_id}", fmt)
            publish(R.dlq_envelope(R.rejected(checked), topic),
                    dlq_path, f"{BATCH_COL}={batch_id}", fmt)
        finally:
            checked.unpersist()
    return write


def kafka_batch_writer(schema: dict, topic: str, dlq_topic: str, bootstrap: str,
                       extra: dict[str, str] | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch body for topics: accepted rows go to ``topic`` under their
    partition key, dead letters as JSON to ``dlq_topic``, in one write of the
    Kafka sink (at least once: a repeated batch sends its rows again)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        checked = R.validate(batch, schema, key="clickstream")
        dead = R.dlq_envelope(R.rejected(checked), topic)
        rows = R.keyed_for_topic(R.accepted(checked), topic, F.col("route_key")).unionByName(
            dead.select(F.lit(None).cast("string").alias("key"),
                        F.to_json(F.struct(*dead.columns)).alias("value"),
                        F.lit(dlq_topic).alias("topic")))
        w = rows.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
        for k, v in (extra or {}).items():
            w = w.option(k, v)
        w.save()
    return write


def start_router(raw: DataFrame, schema: dict, topic: str, accepted_path: str, dlq_path: str,
                 checkpoint: str, fmt: str = "parquet", trigger: dict | None = None,
                 key: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    w = (raw.writeStream
         .foreachBatch(router_batch_writer(schema, topic, accepted_path, dlq_path, key, fmt))
         .option("checkpointLocation", checkpoint))
    return _start(w, trigger)


# --- SCD type 2 ----------------------------------------------------------------

SNAPSHOT = "snapshot"


def _snapshots(spark: SparkSession, dim_root: str) -> list[int]:
    """Numbers of the complete snapshots under ``dim_root``, newest first."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(dim_root)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()]
    found = [n for n in names if n.startswith(f"{SNAPSHOT}=")
             and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{dim_root}/{n}/_SUCCESS"))]
    return sorted((int(n.split("=", 1)[1]) for n in found), reverse=True)


def latest_snapshot(spark: SparkSession, dim_root: str) -> str | None:
    """Newest complete snapshot directory under ``dim_root``."""
    found = _snapshots(spark, dim_root)
    return f"{dim_root}/{SNAPSHOT}={found[0]}" if found else None


def next_snapshot(spark: SparkSession, dim_root: str, changes: DataFrame, source: str | None = None,
                  fmt: str = "parquet", **kw) -> str:
    """Apply ``changes`` to the newest snapshot and publish the next number.

    ``source`` names where the changes come from (a stream and its batch).  It
    is stored with the snapshot in the same step, so a batch that is repeated
    finds itself applied already, and streams, restarts and direct calls share
    one sequence of numbers.  Two writers at once: the second one's publish
    finds the number taken and fails.
    """
    found = _snapshots(spark, dim_root)
    if not found:
        raise ValueError(f"Dimension table not found at {dim_root}")
    if source is not None:
        for n in found:
            if note(spark, f"{dim_root}/{SNAPSHOT}={n}", "source") == source:
                return f"{dim_root}/{SNAPSHOT}={n}"
    name = f"{SNAPSHOT}={found[0] + 1}"
    dim = spark.read.format(fmt).load(f"{dim_root}/{SNAPSHOT}={found[0]}")
    out = C.scd2_apply(dim, changes, **kw)
    if not publish(out, dim_root, name, fmt, {"source": source} if source is not None else None):
        raise RuntimeError(f"{dim_root}/{name} was written by another job meanwhile")
    return f"{dim_root}/{name}"


def expire_snapshots(spark: SparkSession, dim_root: str, keep: int = 10) -> int:
    """Remove all but the ``keep`` newest snapshots; returns how many went."""
    jvm = spark.sparkContext._jvm
    old = _snapshots(spark, dim_root)[max(1, keep):]
    for n in old:
        path = jvm.org.apache.hadoop.fs.Path(f"{dim_root}/{SNAPSHOT}={n}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return len(old)


def scd2_batch_writer(spark: SparkSession, dim_root: str, fmt: str = "parquet",
                      name: str = "stream", **kw) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: the next snapshot after each batch.  ``name`` tells
    streams (and fresh checkpoints) that write the same dimension apart."""
    def write(batch: DataFrame, batch_id: int) -> None:
        next_snapshot(spark, dim_root, batch, f"{name}:{batch_id}", fmt, **kw)
    return write


def start_scd2(changes: DataFrame, dim_root: str, checkpoint: str, fmt: str = "parquet",
               trigger: dict | None = None, **kw) -> StreamingQuery:
    """Apply a change stream (op, ts_ms, before, after, seq) to the dimension
    whose first snapshot is ``<dim_root>/snapshot=0``.  The stream is known by
    an id kept in its checkpoint folder, so a fresh checkpoint is a new one."""
    spark = changes.sparkSession
    identity = note(spark, checkpoint, "dimension_writer")
    if identity is None:
        identity = uuid.uuid4().hex
        put_note(spark, checkpoint, "dimension_writer", identity)
    w = (changes.writeStream.foreachBatch(scd2_batch_writer(spark, dim_root, fmt, identity, **kw))
         .option("checkpointLocation", checkpoint))
    return _start(w, trigger)


# --- silver ------------------------------------------------------------------

def ids_path(silver_path: str) -> str:
    """Where the ids of a silver table are kept: one narrow column per batch."""
    return silver_path.rstrip("/") + "_ids"


def silver_batch_writer(spark: SparkSession, silver_path: str, fmt: str = "parquet",
                        buckets: int = I.ID_BUCKETS) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: earliest copy within the batch, minus event_ids that
    *any* earlier batch stored, cleaned, published as one batch folder.

    A copy may arrive any time later, so every stored id counts.  Ids are kept
    in a table of their own (``streaming.idtable``; ``buckets`` counts when it
    begins), of which a batch reads the buckets that its ids fall into.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        name, ids = f"{BATCH_COL}={batch_id}", ids_path(silver_path)
        fresh = S.deduplicate_events(S.validate_required_fields(batch))
        again = I.known_ids(spark, ids, batch.select("event_id"), batch_id)
        if again is not None:
            fresh = fresh.join(again, "event_id", "left_anti")
        publish(S.process_silver(fresh, dedup=False), silver_path, name, fmt)
        I.publish_ids(spark.read.format(fmt).load(f"{silver_path}/{name}").select("event_id"), ids, name,
                      I.buckets_of(spark, ids, buckets))
    return write


def compact_ids(spark: SparkSession, silver_path: str, upto: int) -> int:
    """Put the ids of all batches up to ``upto`` (ended ones) into one folder
    and remove theirs, so that a long-running stream lists few folders; returns
    how many were merged.  While both exist an id is there twice, which changes
    no result."""
    jvm = spark.sparkContext._jvm
    ids = ids_path(silver_path)
    root = jvm.org.apache.hadoop.fs.Path(ids)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(root)]
    merged = [n for n in names if n.startswith(f"{BATCH_COL}=") and int(n.split("=")[1]) <= upto]
    target = f"{BATCH_COL}={-(upto + 1)}"       # a number before every batch
    if len(merged) < 2:
        return 0
    rows = I.stored_ids(spark, ids, upto + 1).select("event_id")
    if not I.publish_ids(rows, ids, target, I.buckets_of(spark, ids)):
        return 0
    for n in merged:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{ids}/{n}"), True)
    return len(merged)


def start_silver(bronze: DataFrame, silver_path: str, checkpoint: str, fmt: str = "parquet",
                 trigger: dict | None = None, buckets: int = I.ID_BUCKETS) -> StreamingQuery:
    writer = silver_batch_writer(bronze.sparkSession, silver_path, fmt, buckets)
    w = bronze.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    return _start(w, trigger)


def silver_bounded_state(bronze: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Alternative silver stream with bounded dedup state: one copy per
    event_id among copies less than ``lateness`` apart in Kafka time (which
    copy is kept is not specified)."""
    deduped = (S.validate_required_fields(bronze)
               .withWatermark("kafka_timestamp", lateness)
               .dropDuplicatesWithinWatermark(["event_id"]))
    return S.process_silver(deduped, dedup=False)


# --- gold --------------------------------------------------------------------

def start_gold(silver: DataFrame, table: str, out_path: str, checkpoint: str,
               fmt: str = "parquet", trigger: dict | None = None,
               watermark: str | None = None) -> StreamingQuery:
    """One gold table as an append stream (approximate distinct counts)."""
    fn = G.GOLD_TABLES[table]
    agg = fn(silver, watermark) if watermark else fn(silver)
    w = (agg.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint))
    return _start(w, trigger, out_path)


def rows_dropped_by_watermark(query: StreamingQuery) -> int:
    """Late rows dropped in the batches whose progress the query still holds
    (Spark keeps the last 100); the listener in ``late`` adds up all of them."""
    total = 0
    for p in query.recentProgress:
        prog = json.loads(p.json) if hasattr(p, "json") else p
        for op in prog.get("stateOperators", []):
            total += int(op.get("numRowsDroppedByWatermark", 0))
    return total
