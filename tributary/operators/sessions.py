"""Sessions by a gap of inactivity, in batch and on a stream.

A user's session ends when no event follows within the gap; its end is the last
event plus the gap, and an event exactly there still belongs to it.  On a
stream, a late event that falls between two open sessions joins them; a session
is emitted once the watermark has passed its end.

``sessions_by_gap`` uses Spark's session windows (partial sessions merge in map
tasks before the shuffle where ``spark.sql.sessionWindow.merge.sessions.in.local.partition``
is on).  Of a user with a large share of all events every event goes to one
task there; ``sessions_of_hot_users`` spreads such users over ranges of time and
returns the same sessions in batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.functions.exprs import count_when
from tributary.functions.timeparse import micros_of
from tributary.operators.gold import TIME
from tributary.session import materialize

GAP = "30 minutes"
WATERMARK = "10 minutes"


def _measures() -> list[Column]:
    t = F.col("event_type")
    return [F.count(F.lit(1)).alias("events"), count_when(t == "page_view").alias("views"),
            count_when(t == "add_to_cart").alias("cart_adds"), count_when(t == "purchase").alias("purchases"),
            F.sum(F.when(t == "purchase", F.col("cart_value"))).alias("revenue"),
            F.min_by("page_url", F.struct(TIME, "event_id")).alias("entry_page"),
            F.max_by("page_url", F.struct(TIME, "event_id")).alias("exit_page")]


COLUMNS = ["user_id", "session_start", "session_end", "events", "views", "cart_adds", "purchases", "revenue",
           "entry_page", "exit_page"]


def sessions_by_gap(silver: DataFrame, gap: str = GAP, watermark: str | None = WATERMARK) -> DataFrame:
    """One row per user and session: session_start, session_end (last event plus
    the gap), events, views, cart_adds, purchases, revenue (of purchases, null
    when none has a value), entry_page and exit_page.  Rows without user or
    event time belong to no session."""
    rows = silver.where(F.col("user_id").isNotNull() & F.col(TIME).isNotNull())
    rows = rows.withWatermark(TIME, watermark) if watermark else rows
    return (rows.groupBy("user_id", F.session_window(TIME, gap).alias("w")).agg(*_measures())
            .select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"),
                    *COLUMNS[3:]))


def sessions_of_hot_users(silver: DataFrame, gap: str = GAP) -> DataFrame:
    """``sessions_by_gap`` in batch, with a user's events spread over ranges of
    (user, time): within a range sessions are numbered by a window, across
    ranges one row per range and user tells whether its first session goes on
    from the one before; what meets per session are partial sums."""
    rows = silver.where(F.col("user_id").isNotNull() & F.col(TIME).isNotNull()).select(
        "user_id", TIME, "event_id", "event_type", "cart_value", "page_url")
    ranged = materialize(rows.repartitionByRange("user_id", TIME, "event_id")
                         .withColumn("part", F.spark_partition_id()), "session-ranges")
    size = micros_of(gap)
    at = F.unix_micros(TIME)
    local = Window.partitionBy("part", "user_id").orderBy(TIME, "event_id")
    begins = (at - F.lag(at).over(local) > size).cast("int")
    marked = ranged.withColumn("begins", F.coalesce(begins, F.lit(0)))
    numbered = marked.withColumn("nth", F.sum("begins").over(local.rowsBetween(Window.unboundedPreceding, 0)))
    t = F.col("event_type")
    edge = F.struct(TIME, "event_id")
    partial = materialize(numbered.groupBy("part", "user_id", "nth").agg(
        F.min(TIME).alias("start"), F.max(TIME).alias("last"), F.count(F.lit(1)).alias("events"),
        count_when(t == "page_view").alias("views"), count_when(t == "add_to_cart").alias("cart_adds"),
        count_when(t == "purchase").alias("purchases"),
        F.sum(F.when(t == "purchase", F.col("cart_value"))).alias("revenue"),
        F.min_by("page_url", edge).alias("entry"), F.max_by("page_url", edge).alias("exit")), "session-parts")
    # per range and user: sessions, and the outermost events
    spans = partial.groupBy("part", "user_id").agg(
        F.max("nth").alias("most"), F.min("start").alias("first"), F.max("last").alias("final"))
    order = Window.partitionBy("user_id").orderBy("part")
    apart = F.unix_micros("first") - F.unix_micros(F.lag("final").over(order)) > size
    steps = spans.withColumn("new", F.coalesce(apart, F.lit(False)).cast("int"))
    # number of the first session of each range among all of the user
    base = steps.withColumn("base", F.sum(F.col("new")).over(order.rowsBetween(Window.unboundedPreceding, 0))
                            + F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)),
                                         F.lit(0))).select("part", "user_id", "base")
    joined = partial.join(base, ["part", "user_id"]).withColumn("session", F.col("base") + F.col("nth"))
    return (joined.groupBy("user_id", "session").agg(
        F.min("start").alias("session_start"), F.max("last").alias("last"),
        *[F.sum(c).alias(c) for c in ("events", "views", "cart_adds", "purchases", "revenue")],
        F.min_by("entry", F.struct("start", "part")).alias("entry_page"),
        F.max_by("exit", F.struct("last", "part")).alias("exit_page"))
        .withColumn("session_end", F.timestamp_micros(F.unix_micros("last") + F.lit(size))).select(*COLUMNS))


def start_sessions(silver: DataFrame, path: str, checkpoint: str, gap: str = GAP, watermark: str = WATERMARK,
                   trigger: dict | None = None) -> StreamingQuery:
    """Closed sessions of a silver stream, appended (state: the open ones)."""
    w = (sessions_by_gap(silver, gap, watermark).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    return (w.trigger(**trigger) if trigger else w).start(path)
