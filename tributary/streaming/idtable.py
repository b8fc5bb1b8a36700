"""The ids a silver stream has stored, laid out for lookups.

One folder per batch, in it one folder per bucket (a hash of the id), in that
files sorted by id with a Parquet bloom filter.  A batch looks its ids up in
the buckets they fall into only.  A batch of few ids goes further: its ids are
part of the scan's predicate, so row groups are skipped by their smallest and
largest id and by the bloom filter.  A larger one meets its buckets in a join.

The number of buckets is fixed when the table begins (a note beside it), so
that every later batch finds ids where earlier ones put them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tributary.sources.tables import note, publish, put_note, table_exists

BATCH_COL = "batch_id"
ID = "event_id"
BUCKET = "bucket"
# of a new table; a table that is to hold many billions of ids begins with more
ID_BUCKETS = 32
# batches of at most so many different ids put them into the scan's predicate
POINT_IDS = 256
_FORMAT = {f"parquet.bloom.filter.enabled#{ID}": "true",
           "parquet.bloom.filter.adaptive.enabled": "true",
           # ids do not repeat: a dictionary would take the filter's place
           f"parquet.enable.dictionary#{ID}": "false"}


def bucket_of(column: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def buckets_of(spark: SparkSession, path: str, new: int = ID_BUCKETS) -> int:
    """The table's number of buckets; ``new`` is noted where there is none."""
    known = note(spark, path, "buckets")
    if known is None:
        put_note(spark, path, "buckets", str(new))
        return new
    return int(known)


def publish_ids(ids: DataFrame, path: str, name: str, buckets: int) -> bool:
    """Store ``ids`` (one column) as the folder ``name``, complete and once.
    Ranges of (bucket, id) are dealt to tasks, so a large bucket becomes
    several files of disjoint ranges and no task holds a bucket whole."""
    placed = ids.select(ID, bucket_of(F.col(ID), buckets).alias(BUCKET))
    ordered = placed.repartitionByRange(BUCKET, ID).sortWithinPartitions(BUCKET, ID)
    return publish(ordered, path, name, options=_FORMAT, partition_by=[BUCKET])


def stored_ids(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """All stored ids with their bucket (of batches before ``before``)."""
    rows = spark.read.schema(f"{ID} string, {BATCH_COL} int, {BUCKET} int").parquet(path)
    return rows if before is None else rows.where(F.col(BATCH_COL) < before)


def lookup(stored: DataFrame, ids: DataFrame, buckets: int, point_ids: int = POINT_IDS) -> DataFrame:
    """Those of ``ids`` (one column) that ``stored`` holds, as often as it holds
    them (while batches are being merged: twice).  The driver sees the
    buckets that occur (a number fixed by the table), or, of a batch of at most
    ``point_ids`` different ids, the ids themselves."""
    different = ids.select(ID).distinct().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        few = different.limit(point_ids + 1).select(ID, bucket_of(F.col(ID), buckets).alias(BUCKET)).collect()
        if not few:
            return stored.where("false").select(ID)
        if len(few) <= point_ids:
            within = sorted({r[BUCKET] for r in few})
            # one equality per id: these reach the bloom filters
            same = reduce(lambda a, b: a | b, [F.col(ID) == r[ID] for r in few if r[ID] is not None], F.lit(False))
            return stored.where(F.col(BUCKET).isin(within) & same).select(ID)
        within = different.agg(F.collect_set(bucket_of(F.col(ID), buckets))).first()[0]
    finally:
        different.unpersist()
    return stored.where(F.col(BUCKET).isin(sorted(within))).select(ID).join(
        ids.select(ID).distinct(), ID, "left_semi")


def known_ids(spark: SparkSession, path: str, ids: DataFrame, before: int,
              point_ids: int = POINT_IDS) -> DataFrame | None:
    """Those of ``ids`` that batches before ``before`` have stored; None when
    there is no table yet."""
    if not table_exists(spark, path):
        return None
    return lookup(stored_ids(spark, path, before), ids, buckets_of(spark, path), point_ids)
