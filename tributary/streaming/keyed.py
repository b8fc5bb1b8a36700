"""SCD type 2 as keyed state: a stream of changes to a log of versions.

The state of a key is its newest version and the place of the last change
applied; no snapshot is read.  Each version makes one row when it opens and one
when it is closed, appended to a log; ``versions`` puts both together.  State
lies in RocksDB, so the number of keys is not bounded by memory.  The keys of a
bucket (a hash of the key) lie side by side in one state value and are handled
in one call, so a micro-batch makes a call per bucket it touches, not per key.
The number of buckets is fixed when a stream begins (a note in its checkpoint).

Changes of a key are applied in order of time and feed position within a
micro-batch.  A change that is older than the last one applied to its key cannot
be put in its place any more: it changes nothing and makes a row of kind
``late``, so that it can be applied elsewhere (``dimension.apply_batch``).
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tributary.operators import scd2 as C
from tributary.sources.tables import note, put_note

OPENED, CLOSED, LATE = "opened", "closed", "late"
LOG = ("kind string, user_id string, name string, email string, version int, effective_from long, "
       "effective_to long")
# one entry per key in each of the arrays
_STATE = ("user_id array<string>, is_open array<boolean>, version array<int>, since array<long>, "
          "last array<long>, last_seq array<long>")
_NEW = (False, 0, 0, None, None)
# place of a change without a feed position: before all others of its instant
NO_SEQ = -2**63
BUCKET = "bucket"
# of a new stream; more for one whose buckets would outgrow some ten thousand keys
BUCKETS = 1024
CONF = {"spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class _Versions(StatefulProcessor):
    """The newest version of each key of one bucket."""

    def init(self, handle) -> None:
        self.newest = handle.getValueState("newest", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        columns = ["user_id", "micros", "seq", "opens", "name", "email"]
        changes = [r for frame in rows for r in frame[columns].itertuples(index=False, name=None)]
        changes.sort(key=itemgetter(1, 2))
        state = self.newest.get()
        known = {} if state is None else {user: own for user, *own in zip(*state, strict=True)}
        out = []
        for user, micros, seq, opens, name, email in changes:
            is_open, version, since, last, last_seq = known.get(user, _NEW)
            if last is not None and (micros < last or micros == last and NO_SEQ < seq <= last_seq):
                out.append((LATE, user, name, email, None, micros, None))
                continue
            if is_open:
                out.append((CLOSED, user, None, None, version, since, micros))
            if opens:
                version, since = version + 1, micros
                out.append((OPENED, user, name, email, version, since, None))
            known[user] = (bool(opens), version, since, micros, seq)
        self.newest.update(tuple(map(list, zip(*((user, *own) for user, own in known.items()), strict=True))))
        frame = pd.DataFrame(out, columns=["kind", "user_id", "name", "email", "version", "effective_from",
                                           "effective_to"])
        yield frame.astype({"version": "Int32", "effective_from": "Int64", "effective_to": "Int64"})

    def close(self) -> None:
        pass


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def buckets_of(spark: SparkSession, checkpoint: str, new: int = BUCKETS) -> int:
    """The stream's number of buckets; ``new`` is noted where there is none."""
    known = note(spark, checkpoint, "buckets")
    if known is None:
        put_note(spark, checkpoint, "buckets", str(new))
        return new
    return int(known)


def start_versions(changes: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                   snapshot_reads: str = "ignore", buckets: int = BUCKETS) -> StreamingQuery:
    """Change stream (op, ts_ms, before, after, seq) → the log of versions at
    ``path``.  An initial dimension comes first, as creates (``as_creates``).
    A task holds the changes and keys of one bucket of a micro-batch at a time;
    limit the source's batch where one key may have very many.  ``buckets``
    counts when the stream begins."""
    spark = changes.sparkSession
    rows = C.change_events(changes, None, "event", snapshot_reads).select(
        bucket_of(F.col("user_id"), buckets_of(spark, checkpoint, buckets)).alias(BUCKET),
        "user_id", "name", "email", "opens", F.unix_micros("t").alias("micros"),
        F.coalesce("seq", F.lit(NO_SEQ)).alias("seq"))
    log = rows.groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=_Versions(), outputStructType=LOG, outputMode="Append", timeMode="None")
    w = log.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():           # a query keeps the settings it was started with
        spark.conf.set(k, v)
    try:
        return (w.trigger(**trigger) if trigger else w).start(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def as_creates(dim: DataFrame) -> DataFrame:
    """The open rows of a dimension as change records, before all others of
    their instant."""
    image = F.struct("user_id", "name", "email")
    return dim.where("is_current").select(
        F.lit("c").alias("op"), F.unix_millis("effective_from").alias("ts_ms"),
        F.when(F.lit(False), image).alias("before"), image.alias("after"), F.lit(-1).cast("long").alias("seq"))


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The dimension that a log describes: one row per version."""
    log = spark.read.schema(LOG).parquet(path).where(F.col("kind") != LATE)
    opened = F.col("kind") == OPENED
    rows = log.groupBy("user_id", "version").agg(
        F.max(F.when(opened, F.col("name"))).alias("name"), F.max(F.when(opened, F.col("email"))).alias("email"),
        F.min("effective_from").alias("since"), F.max("effective_to").alias("until"))
    return rows.select("user_id", "name", "email", F.timestamp_micros("since").alias("effective_from"),
                       F.timestamp_micros("until").alias("effective_to"), F.col("until").isNull().alias("is_current"),
                       "version")


def late_changes(spark: SparkSession, path: str) -> DataFrame:
    """Changes that came after a newer one of their key: user_id, name, email
    and their time."""
    return spark.read.schema(LOG).parquet(path).where(F.col("kind") == LATE).select(
        "user_id", "name", "email", F.timestamp_micros("effective_from").alias("t"))
