"""Slowly changing dimension, type 2, from a change feed — as set operations.

``initialize_dimension`` opens version 1 of every row.  ``scd2_apply(dim,
changes)`` returns the next snapshot of the dimension:

* the history of every touched key is put in order of time (event time
  ``ts_ms``, then what was known before this batch, then the feed position)
  together with its new changes, and its intervals are made anew; so a change
  that arrives late takes its place in time, and no version ends before it
  begins;
* ``c`` and ``u`` open a version, ``d`` opens none; every change closes the
  version open before it; ``r`` (snapshot read) is ignored unless
  ``snapshot_reads="create"``; other ops are ignored;
* ``effective_to`` is the time of the next change; ``is_current`` = no later
  change; versions count on from the key's smallest number, in order of time
  (a late change renumbers the versions after it);
* rows of untouched keys pass through unchanged;
* a delete where no version is open changes nothing and leaves no trace.

With one change per key per batch, in order, this equals a MERGE that closes
the current row and appends the new one.  ``time_source="batch"`` stamps every
change with ``now`` (the batch time) instead of its own time.  Columns of the
dimension beyond the standard ones stay with their rows; versions that a
change opens have NULL there.

Scale: the changes are parsed once (written to the shared folder); the
dimension is split by the distinct touched keys with a semi- and an anti-join
(AQE picks broadcast or sort-merge from measured sizes and splits skewed
partitions); the per-key order runs through ``ordered_scan``, so a key with a
huge share of the changes is spread over several tasks; the per-key version
base is a partial aggregate.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tributary.functions.exprs import fence
from tributary.operators.ordered import ordered_scan
from tributary.session import materialize

DIM_COLUMNS = ["user_id", "name", "email", "effective_from", "effective_to",
               "is_current", "version"]

# FIXED VALUES — the change-record schema read by the handler.
USER_IMAGE = StructType([StructField("user_id", StringType()),
                         StructField("name", StringType()),
                         StructField("email", StringType())])
CHANGE_STRUCT = StructType([
    StructField("op", StringType()),
    StructField("ts_ms", LongType()),
    StructField("before", USER_IMAGE),
    StructField("after", USER_IMAGE),
])


def _now_col(now: Column | _dt.datetime | None) -> Column:
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    return F.lit(now).cast("timestamp")


def parse_changes(messages: DataFrame, value_col: str = "value",
                  seq_col: str | None = "offset") -> DataFrame:
    """Kafka-shaped change records → op, ts_ms, before, after, seq."""
    parsed = messages.select(
        F.from_json(F.col(value_col).cast("string"), CHANGE_STRUCT).alias("c"),
        (F.col(seq_col) if seq_col else F.monotonically_increasing_id()).alias("seq"))
    # fenced, so filters on the op are not pushed beneath the parse (which
    # would copy from_json into every predicate)
    return fence(parsed).select("c.op", "c.ts_ms", "c.before", "c.after", "seq")


def initialize_dimension(users: DataFrame, now: Column | _dt.datetime | None = None) -> DataFrame:
    """Version 1 of every row: effective now, open-ended, current.  Further
    columns of ``users`` are kept, after the standard ones."""
    more = [c for c in users.columns if c not in DIM_COLUMNS]
    return users.select(
        "user_id", "name", "email",
        _now_col(now).alias("effective_from"),
        F.lit(None).cast("timestamp").alias("effective_to"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version"), *more)


def change_events(changes: DataFrame, now: Column | _dt.datetime | None = None,
                  time_source: str = "event", snapshot_reads: str = "ignore") -> DataFrame:
    """Change records → one row per applicable change: user_id, name, email,
    opens (BOOLEAN), t (TIMESTAMP), seq."""
    ops = ["c", "u", "d"] + (["r"] if snapshot_reads == "create" else [])
    now_c = _now_col(now)
    if time_source == "event":
        t = F.coalesce(F.timestamp_millis("ts_ms"), now_c)
    elif time_source == "batch":
        t = now_c
    else:
        raise ValueError("time_source must be 'event' or 'batch'")
    is_delete = F.col("op") == "d"
    seq = F.col("seq") if "seq" in changes.columns else F.lit(0).cast("bigint")
    return (changes.filter(F.col("op").isin(ops))
            .select(F.when(is_delete, F.col("before.user_id"))
                     .otherwise(F.col("after.user_id")).alias("user_id"),
                    F.when(is_delete, F.lit(None)).otherwise(F.col("after.name")).alias("name"),
                    F.when(is_delete, F.lit(None)).otherwise(F.col("after.email")).alias("email"),
                    (~is_delete).alias("opens"), t.alias("t"), seq.cast("bigint").alias("seq"))
            .filter(F.col("user_id").isNotNull()))


def late_changes(dim: DataFrame, changes: DataFrame,
                 now: Column | _dt.datetime | None = None,
                 time_source: str = "event") -> DataFrame:
    """Changes whose time is before the effective_from of their key's current
    version (one current row per key; the join splits skewed keys under AQE)."""
    ev = change_events(changes, now, time_source)
    current = dim.filter(F.col("is_current")).select(
        "user_id", F.col("effective_from").alias("current_from"))
    return ev.join(current, "user_id").filter(F.col("t") < F.col("current_from"))


def max_versions(dim: DataFrame) -> DataFrame:
    """Highest version per user_id (partial aggregate)."""
    return dim.groupBy("user_id").agg(F.max("version").alias("max_version"))


def scd2_apply(dim: DataFrame, changes: DataFrame, now: Column | _dt.datetime | None = None,
               time_source: str = "event", snapshot_reads: str = "ignore") -> DataFrame:
    """Next snapshot of ``dim`` after ``changes`` (see module docstring)."""
    more = [c for c in dim.columns if c not in DIM_COLUMNS]
    ev = materialize(change_events(changes, now, time_source, snapshot_reads), "changes")
    touched = ev.select("user_id").distinct()
    untouched = dim.join(touched, "user_id", "left_anti").select(*DIM_COLUMNS, *more)
    known = dim.join(touched, "user_id", "left_semi")

    # known rows as the changes that made them: each opens its version and, if
    # it has an end, is closed there.  At one instant known closings come
    # first, then known openings, then new changes; a version that ended where
    # it began is closed after it was opened.
    instant = F.coalesce(F.col("effective_to") == F.col("effective_from"), F.lit(False))
    opened = known.select(
        "user_id", "name", "email", F.lit(True).alias("opens"), F.col("effective_from").alias("t"),
        F.lit(1).alias("grp"), (F.col("version").cast("bigint") * 2).alias("seq"), *more)
    closed = known.filter(F.col("effective_to").isNotNull()).select(
        "user_id", F.lit(False).alias("opens"), F.col("effective_to").alias("t"),
        F.when(instant, 1).otherwise(0).alias("grp"),
        (F.col("version").cast("bigint") * 2 + 1).alias("seq"))
    rows = (opened.unionByName(closed, allowMissingColumns=True)
            .unionByName(ev.withColumn("grp", F.lit(2)), allowMissingColumns=True))

    base = known.groupBy("user_id").agg((F.min("version") - 1).alias("offset"))
    scanned = ordered_scan(rows, "user_id", ["t", "grp", "seq"], F.col("opens"),
                           lead_of="t", count_out="rc", lead_out="next_t", key_offsets=base)
    rebuilt = scanned.filter(F.col("opens")).select(
        "user_id", "name", "email", F.col("t").alias("effective_from"),
        F.col("next_t").alias("effective_to"), F.col("next_t").isNull().alias("is_current"),
        F.col("rc").cast("int").alias("version"), *more)
    return untouched.unionByName(rebuilt)


def apply_changes_to_table(spark, dim_path: str, changes: DataFrame, out_path: str,
                           now: Column | _dt.datetime | None = None, fmt: str = "parquet",
                           **kw) -> str:
    """Read the snapshot at ``dim_path``, apply ``changes``, write the next
    snapshot to ``out_path`` (a new directory: a table is never overwritten
    while it is being read).  Raises ValueError when ``dim_path`` is missing.
    """
    from tributary.sources.tables import table_exists

    if not table_exists(spark, dim_path, fmt):
        raise ValueError(f"Dimension table not found at {dim_path}")
    dim = spark.read.format(fmt).load(dim_path)
    scd2_apply(dim, changes, now, **kw).write.format(fmt).mode("overwrite").save(out_path)
    return out_path
