"""A landed topic with an index of offsets and times, read like a topic.

    root/data/<batch>/    records (Kafka's columns), files in ranges of
                          (topic, partition, offset)
    root/index/<batch>/   per file, topic and partition: first and last offset,
                          oldest and newest record time, rows

Reads take starting and ending offsets per partition, or start times, and open
the files that the index names only; within them the bounds are part of the
scan's predicate.  ``run_bronze`` is the stream over such a log: it keeps the
next offset of every partition with each batch it publishes, so that a restart
goes on there, takes at most so many records a batch, and either fails or goes
on where records it has not read yet were removed.

The driver learns the bounds of the partitions and the names of the files that
take part; files are only ever read and written by Spark, in whatever store the
session reaches.
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.bronze import process_bronze
from tributary.sources.kafka import KAFKA_SCHEMA
from tributary.sources.tables import folder_names, note, publish, remove_folder

Key = tuple[str, int]           # topic, partition
Offsets = dict[Key, int]
_INDEX = "file string, topic string, partition int, first long, last long, oldest timestamp, newest timestamp, rows long"


class DataLoss(RuntimeError):
    """Records that were to be read are gone."""


def append(records: DataFrame, root: str, name: str, files: int | None = None) -> bool:
    """Land ``records`` as the batch ``name`` (complete and once).  ``files``:
    number of ranges of (topic, partition, offset) they are dealt into; by
    default Spark's own choice."""
    keys = ["topic", "partition", "offset"]
    rows = records.select(*KAFKA_SCHEMA.names)
    ranged = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    new = publish(ranged.sortWithinPartitions(*keys), f"{root}/data", name)
    spark = records.sparkSession
    landed = spark.read.schema(KAFKA_SCHEMA).parquet(f"{root}/data/{name}")
    index = landed.groupBy(F.col("_metadata.file_path").alias("file"), "topic", "partition").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.min("timestamp").alias("oldest"),
        F.max("timestamp").alias("newest"), F.count(F.lit(1)).alias("rows"))
    return publish(index.coalesce(1), f"{root}/index", name) or new


def expire(spark: SparkSession, root: str, name: str) -> None:
    """Remove a batch of records, as a topic's retention does."""
    remove_folder(spark, f"{root}/index/{name}")
    remove_folder(spark, f"{root}/data/{name}")


def index(spark: SparkSession, root: str) -> DataFrame:
    names = [n for n in folder_names(spark, f"{root}/index") if n[0] not in "_."]
    if not names:
        return spark.createDataFrame([], _INDEX)
    return spark.read.schema(_INDEX).parquet(*[f"{root}/index/{n}" for n in names])


@dataclass(frozen=True)
class Bounds:
    first: Offsets              # of each partition, the first offset there is
    end: Offsets                # and the one after the last


def bounds(spark: SparkSession, root: str) -> Bounds:
    rows = index(spark, root).groupBy("topic", "partition").agg(F.min("first"), F.max("last")).collect()
    return Bounds({(r[0], r[1]): r[2] for r in rows}, {(r[0], r[1]): r[3] + 1 for r in rows})


def offsets_at(spark: SparkSession, root: str, time: _dt.datetime) -> Offsets:
    """Per partition the first offset whose record time is at or after
    ``time``; partitions without one are left out.  Files of a partition hold
    ranges of offsets, so the first file with a new enough record holds it."""
    at = F.lit(time).cast("timestamp")
    files = (index(spark, root).where(F.col("newest") >= at).groupBy("topic", "partition")
             .agg(F.min_by("file", "first").alias("file")).collect())
    if not files:
        return {}
    rows = (spark.read.schema(KAFKA_SCHEMA).parquet(*sorted({r["file"] for r in files}))
            .where(F.col("timestamp") >= at).groupBy("topic", "partition").agg(F.min("offset")).collect())
    named = {(r["topic"], r["partition"]) for r in files}
    return {(r[0], r[1]): r[2] for r in rows if (r[0], r[1]) in named}


def read_offsets(spark: SparkSession, root: str, start: Offsets, end: Offsets) -> DataFrame:
    """The records from ``start`` up to (not including) ``end``, of the
    partitions that both name.  Opens the files that hold any of them."""
    spans = {k: (start[k], end[k]) for k in start.keys() & end.keys() if start[k] < end[k]}
    if not spans:
        return spark.createDataFrame([], KAFKA_SCHEMA)

    def any_of(condition) -> Column:
        return reduce(lambda a, b: a | b, [
            (F.col("topic") == t) & (F.col("partition") == p) & condition(*span) for (t, p), span in spans.items()])

    files = [r[0] for r in index(spark, root).where(
        any_of(lambda lo, hi: (F.col("last") >= lo) & (F.col("first") < hi))).select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], KAFKA_SCHEMA)
    return spark.read.schema(KAFKA_SCHEMA).parquet(*sorted(files)).where(
        any_of(lambda lo, hi: (F.col("offset") >= lo) & (F.col("offset") < hi)))


def _known(given: Offsets, have: Bounds, fail_on_data_loss: bool) -> Offsets:
    """``given`` where records are still there; partitions that are new begin
    at their first record."""
    out = {}
    for key, first in have.first.items():
        want = given.get(key, first)
        if want < first and fail_on_data_loss:
            raise DataLoss(f"{key[0]}-{key[1]}: offset {want} is gone, the first is {first}")
        out[key] = max(want, first)
    gone = given.keys() - have.first.keys()
    if gone and fail_on_data_loss:
        raise DataLoss(f"no records of {sorted(gone)}")
    return out


def replay(spark: SparkSession, root: str, start_offset: int | Offsets | None = None,
           start_timestamp: _dt.datetime | None = None, end_offset: int | Offsets | None = None,
           fail_on_data_loss: bool = False) -> DataFrame:
    """A bounded read with the rules of a topic: an offset wins over a time,
    else from the first record; up to ``end_offset`` (exclusive), else the
    last record.  One number stands for every partition."""
    have = bounds(spark, root)
    if start_offset is not None:
        given = start_offset if isinstance(start_offset, dict) else dict.fromkeys(have.first, start_offset)
        # one number for all is no claim that every partition reaches so far back
        start = _known(given, have, fail_on_data_loss and isinstance(start_offset, dict))
    elif start_timestamp is not None:
        start = offsets_at(spark, root, start_timestamp)
    else:
        start = have.first
    limit = end_offset if isinstance(end_offset, dict) else dict.fromkeys(
        have.end, end_offset) if end_offset is not None else {}
    end = {k: min(last, limit.get(k, last)) for k, last in have.end.items()}
    return read_offsets(spark, root, start, end)


# --- the stream over a log -------------------------------------------------------

def _text(offsets: Offsets) -> str:
    out: dict[str, dict[str, int]] = {}
    for (topic, partition), o in sorted(offsets.items()):
        out.setdefault(topic, {})[str(partition)] = o
    return json.dumps(out)


def _offsets(text: str) -> Offsets:
    return {(t, int(p)): o for t, parts in json.loads(text).items() for p, o in parts.items()}


def committed(spark: SparkSession, table: str) -> tuple[int, Offsets | None]:
    """The newest batch of a table that ``run_bronze`` writes, and the next
    offsets kept with it; (-1, None) when there is none."""
    done = [int(n.split("=", 1)[1]) for n in folder_names(spark, table) if n.startswith("batch_id=")]
    if not done:
        return -1, None
    text = note(spark, f"{table}/batch_id={max(done)}", "offsets")
    return max(done), _offsets(text) if text else None


def _limited(start: Offsets, end: Offsets, most: int | None) -> Offsets:
    """``end``, or so far that at most ``most`` offsets lie between, shared out
    by what each partition has waiting (at least one goes on)."""
    waiting = {k: end[k] - start[k] for k in start if end[k] > start[k]}
    total = sum(waiting.values())
    if most is None or total <= most:
        return end
    share = {k: max(1, n * most // total) for k, n in waiting.items()}
    out = {k: start[k] + min(n, share[k]) for k, n in waiting.items()}
    return {**{k: start[k] for k in start}, **out}


def run_bronze(spark: SparkSession, root: str, table: str, starting: Offsets | None = None,
               max_offsets: int | None = None, fail_on_data_loss: bool = False,
               now: Column | None = None, max_batches: int | None = None) -> int:
    """Log → bronze table until nothing is waiting (or ``max_batches`` are
    done); returns the batches written.

    A first run begins at ``starting`` (default: the first records), later ones
    at the offsets stored with the newest batch: rows and offsets are published
    in one step, so no record comes twice or is left out, however a run ends.
    """
    written = 0
    while max_batches is None or written < max_batches:
        have = bounds(spark, root)
        batch, stored = committed(spark, table)
        start = _known(stored if stored is not None else starting or {}, have, fail_on_data_loss)
        end = _limited(start, {k: max(start[k], have.end[k]) for k in start}, max_offsets)
        if all(end[k] <= start[k] for k in start):
            return written
        rows = process_bronze(read_offsets(spark, root, start, end), now)
        # partitions without records now keep their place
        publish(rows, table, f"batch_id={batch + 1}", notes={"offsets": _text({**(stored or {}), **end})})
        written += 1
    return written
