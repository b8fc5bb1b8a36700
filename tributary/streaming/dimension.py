"""A slowly changing dimension in buckets: a batch of changes rewrites the
buckets of the keys it touches, all others stay as they are.

    root/data/<folder>/bucket=<b>/   files; a folder per applied batch, with
                                     the buckets that it rewrote
    root/snapshot=<n>/_manifest      JSON: number of buckets, for each bucket
                                     the folder that holds it now, and the last
                                     batch applied of each source

A snapshot is its manifest, so it costs a few bytes per bucket, and older
snapshots stay readable until ``expire``.  It is published by one rename: a
batch that fails before leaves files that no manifest names, a batch that is
repeated finds itself applied in the newest manifest, and of two writers the
second finds the number taken.  Buckets are a hash of the key; ranges of
(bucket, key, version) are dealt to the writing tasks, so that one large key
does not fill one task.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tributary.operators import scd2 as C
from tributary.session import materialize
from tributary.sources.tables import (
    folder_names,
    note,
    publish,
    publish_notes,
    put_note,
    remove_folder,
)

SNAPSHOT = "snapshot"
BUCKET = "bucket"
KEY = "user_id"
# of a new dimension; more for one whose buckets would outgrow a few GB
BUCKETS = 64


@dataclass(frozen=True)
class Manifest:
    snapshot: int
    buckets: int
    folders: dict[int, str]         # bucket -> folder under data; empty buckets have none
    sources: dict[str, int]         # source -> its last batch applied
    schema: StructType
    rewritten: int = 0              # buckets that the batch behind this snapshot wrote

    def text(self) -> str:
        return json.dumps({"snapshot": self.snapshot, "buckets": self.buckets, "folders": self.folders,
                           "sources": self.sources, "rewritten": self.rewritten,
                           "schema": self.schema.jsonValue()})


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def snapshots(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the snapshots under ``root``, newest first."""
    names = [n.split("=", 1) for n in folder_names(spark, root) if n.startswith(f"{SNAPSHOT}=")]
    return sorted((int(n) for _, n in names), reverse=True)


def manifest(spark: SparkSession, root: str, snapshot: int | None = None) -> Manifest:
    """The manifest of a snapshot (the newest by default)."""
    if snapshot is None:
        found = snapshots(spark, root)
        if not found:
            raise ValueError(f"Dimension table not found at {root}")
        snapshot = found[0]
    text = note(spark, f"{root}/{SNAPSHOT}={snapshot}", "manifest")
    if text is None:
        raise ValueError(f"no snapshot {snapshot} at {root}")
    m = json.loads(text)
    return Manifest(m["snapshot"], m["buckets"], {int(b): f for b, f in m["folders"].items()}, m["sources"],
                    StructType.fromJson(m["schema"]), m["rewritten"])


def _rows(spark: SparkSession, root: str, m: Manifest, within: set[int] | None = None) -> DataFrame:
    paths = [f"{root}/data/{folder}/{BUCKET}={b}" for b, folder in sorted(m.folders.items())
             if within is None or b in within]
    if not paths:
        return spark.createDataFrame([], m.schema)
    return spark.read.schema(m.schema).parquet(*paths)


def read_dimension(spark: SparkSession, root: str, snapshot: int | None = None,
                   keys: list[str] | None = None) -> DataFrame:
    """A snapshot of the dimension; with ``keys``, only the rows of these keys,
    from their buckets."""
    m = manifest(spark, root, snapshot)
    if keys is None:
        return _rows(spark, root, m)
    at = spark.createDataFrame([(k,) for k in keys], f"{KEY} string").select(bucket_of(F.col(KEY), m.buckets))
    return _rows(spark, root, m, {r[0] for r in at.collect()}).where(F.col(KEY).isin(keys))


def _stored(df: DataFrame, root: str, buckets: int, order: list[str]) -> tuple[str, set[int]]:
    """``df`` written as a data folder by bucket: its name and buckets."""
    placed = df.withColumn(BUCKET, bucket_of(F.col(KEY), buckets))
    name = uuid.uuid4().hex
    publish(placed.repartitionByRange(BUCKET, *order).sortWithinPartitions(BUCKET, *order),
            f"{root}/data", name, partition_by=[BUCKET])
    found = {int(n.split("=", 1)[1]) for n in folder_names(df.sparkSession, f"{root}/data/{name}")
             if n.startswith(f"{BUCKET}=")}
    return name, found


def create_dimension(dim: DataFrame, root: str, buckets: int = BUCKETS) -> Manifest:
    """Snapshot 0 from the rows of a dimension (``scd2.initialize_dimension``)."""
    name, found = _stored(dim, root, buckets, [KEY, "version"])
    m = Manifest(0, buckets, dict.fromkeys(found, name), {}, dim.schema, len(found))
    if not publish_notes(dim.sparkSession, root, f"{SNAPSHOT}=0", {"manifest": m.text()}):
        raise RuntimeError(f"there is a dimension at {root} already")
    return m


def apply_batch(spark: SparkSession, root: str, changes: DataFrame, source: str | None = None,
                batch: int = 0, **kw) -> Manifest:
    """Apply ``changes`` (op, ts_ms, before, after, seq) to the newest snapshot
    and publish the next one; ``kw`` as in ``scd2.scd2_apply``.

    Only the buckets of keys that occur are read and written.  The driver
    learns which buckets those are, a number the table fixes.  A batch of a
    ``source`` that is not after the last one applied changes nothing, nor does
    a batch without applicable changes.
    """
    m = manifest(spark, root)
    if source is not None and m.sources.get(source, -1) >= batch:
        return m
    given = materialize(changes, "dimension-changes")
    touched = C.change_events(given, **kw).select(bucket_of(F.col(KEY), m.buckets).alias(BUCKET))
    within = {r[BUCKET] for r in touched.distinct().collect()}
    if not within and source is None:
        return m
    folders = dict(m.folders)
    if within:
        after = C.scd2_apply(_rows(spark, root, m, within), given, **kw)
        name, found = _stored(after.select(*m.schema.names), root, m.buckets, [KEY, "version"])
        for b in within:
            folders.pop(b, None)
        folders.update(dict.fromkeys(found, name))
    sources = m.sources if source is None else {**m.sources, source: batch}
    out = Manifest(m.snapshot + 1, m.buckets, folders, sources, m.schema, len(within))
    if not publish_notes(spark, root, f"{SNAPSHOT}={out.snapshot}", {"manifest": out.text()}):
        raise RuntimeError(f"{root}/{SNAPSHOT}={out.snapshot} was written by another job meanwhile")
    return out


def expire(spark: SparkSession, root: str, keep: int = 10) -> int:
    """Forget all but the ``keep`` newest snapshots and remove the data folders
    that none of them names; returns how many folders went.  Not while a batch
    is being applied: its files have no manifest yet."""
    numbers = snapshots(spark, root)
    for n in numbers[max(1, keep):]:
        remove_folder(spark, f"{root}/{SNAPSHOT}={n}")
    used = {f for n in numbers[:max(1, keep)] for f in manifest(spark, root, n).folders.values()}
    old = [n for n in folder_names(spark, f"{root}/data") if n not in used and n[0] not in "_."]
    for n in old:
        remove_folder(spark, f"{root}/data/{n}")
    return len(old)


def batch_writer(spark: SparkSession, root: str, source: str, **kw) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: the next snapshot after each batch of ``source``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        apply_batch(spark, root, batch, source, batch_id, **kw)
    return write


def start_dimension(changes: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
                    **kw) -> StreamingQuery:
    """Apply a change stream to the dimension at ``root``.  The stream is known
    by an id kept in its checkpoint folder, so a fresh checkpoint is a new one."""
    spark = changes.sparkSession
    identity = note(spark, checkpoint, "dimension_writer")
    if identity is None:
        identity = uuid.uuid4().hex
        put_note(spark, checkpoint, "dimension_writer", identity)
    w = changes.writeStream.foreachBatch(batch_writer(spark, root, identity, **kw)).option(
        "checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()
