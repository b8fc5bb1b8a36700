"""Late rows of a gold stream kept beside it instead of dropped.

A gold stream forgets rows whose window the watermark has passed.  Here a step
before it divides each silver batch: rows whose window ended at or before the
batch's watermark go to a ``late`` folder with the watermark that they missed,
rows without an event time too; all others are handed to the gold stream.  The
newest event time seen is kept as a note with each batch, in the same step as
its rows, so a repeated batch and a restart see the watermark that the first
attempt saw.

The gold stream reads only what this step let through, and its own watermark
never runs ahead of this one (it knows no newer row), so it drops nothing:
gold and late rows together are all silver rows.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.storagelevel import StorageLevel

from tributary.fixed import (
    WATERMARK_ACTIVE_USERS,
    WATERMARK_CONVERSION_RATE,
    WATERMARK_EVENTS_PER_MINUTE,
    WATERMARK_POPULAR_PRODUCTS,
)
from tributary.functions.timeparse import micros_of
from tributary.operators.gold import TIME
from tributary.sources.tables import folder_names, note, publish
from tributary.streaming.jobs import BATCH_COL

# the smallest window a gold stream closes (sliding windows: their panes) and
# how late a row may be
GRAIN = {
    "events_per_minute": ("1 minute", WATERMARK_EVENTS_PER_MINUTE),
    "conversion_rate": ("5 minutes", WATERMARK_CONVERSION_RATE),
    "popular_products": ("5 minutes", WATERMARK_POPULAR_PRODUCTS),
    "active_users_hourly": ("1 hour", WATERMARK_ACTIVE_USERS),
}
LATE, UNTIMED = "late", "no event time"


def window_end(time: Column, size: str) -> Column:
    """End of the tumbling window of ``size`` that holds ``time``."""
    micros = micros_of(size)
    at = F.unix_micros(time)
    return F.timestamp_micros(at - F.pmod(at, F.lit(micros)) + F.lit(micros))


def newest_time(spark: SparkSession, path: str, before: int) -> int | None:
    """The newest event time (microseconds) that batches before ``before`` saw."""
    done = [int(n.split("=", 1)[1]) for n in folder_names(spark, path) if n.startswith(f"{BATCH_COL}=")]
    earlier = [n for n in done if n < before]
    if not earlier:
        return None
    text = note(spark, f"{path}/{BATCH_COL}={max(earlier)}", "newest")
    return int(text) if text else None


def divide(batch: DataFrame, newest: int | None, size: str, lateness: str) -> DataFrame:
    """``batch`` with ``watermark`` (null before the first time is known) and
    ``reason`` (null: in time)."""
    watermark = (F.lit(None).cast("timestamp") if newest is None
                 else F.expr(f"timestamp_micros({newest}) - INTERVAL {lateness}"))
    missed = window_end(F.col(TIME), size) <= F.col("watermark")
    return batch.withColumn("watermark", watermark).withColumn(
        "reason", F.when(F.col(TIME).isNull(), UNTIMED).when(missed, LATE))


def late_batch_writer(spark: SparkSession, table: str, ontime_path: str, late_path: str,
                      lateness: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch body for the gold table ``table``: silver rows in time to
    ``ontime_path``, the others with ``watermark`` and ``reason`` to
    ``late_path``, each as a batch folder, complete and once."""
    size, allowed = GRAIN[table]

    def write(batch: DataFrame, batch_id: int) -> None:
        name = f"{BATCH_COL}={batch_id}"
        newest = newest_time(spark, ontime_path, batch_id)
        divided = divide(batch.drop(BATCH_COL), newest, size, lateness or allowed).persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            top = divided.agg(F.max(F.unix_micros(TIME))).first()[0]
            seen = max([x for x in (newest, top) if x is not None], default=None)
            # late rows first: the note that moves the watermark comes last
            publish(divided.where("reason is not null"), late_path, name)
            publish(divided.where("reason is null").drop("watermark", "reason"), ontime_path, name,
                    notes={"newest": "" if seen is None else str(seen)})
        finally:
            divided.unpersist()
    return write


def start_late_split(silver: DataFrame, table: str, ontime_path: str, late_path: str, checkpoint: str,
                     trigger: dict | None = None, lateness: str | None = None) -> StreamingQuery:
    """The dividing step as a stream; ``jobs.start_gold`` goes on from
    ``ontime_path`` (``lateness`` must be that of the gold stream)."""
    w = silver.writeStream.foreachBatch(
        late_batch_writer(silver.sparkSession, table, ontime_path, late_path, lateness)).option(
        "checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


class ProgressTotals(StreamingQueryListener):
    """Adds up every progress event of the session's streams, by query id
    (which a checkpoint keeps over restarts): batches, input rows, and rows
    that state operators dropped behind the watermark.  Unlike a query's own
    recent progress it forgets none.  ``spark.streams.addListener`` starts it."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        with self._lock:
            t = self._totals.setdefault(str(p.id), {"batches": 0, "rows": 0, "dropped": 0})
            t["batches"] += 1
            t["rows"] += max(0, p.numInputRows)
            t["dropped"] += dropped

    def of(self, query: StreamingQuery) -> dict[str, int]:
        with self._lock:
            return dict(self._totals.get(str(query.id), {"batches": 0, "rows": 0, "dropped": 0}))
