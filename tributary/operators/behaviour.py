"""Behaviour queries over silver events and the change feed.

* ``event_transitions`` — first-order transition counts and probabilities
  between consecutive event types of a session (plus the session start);
* ``session_summary`` — per session: user, start, end, events, distinct
  products added to the cart;
* ``cart_abandonment`` — sessions whose last cart add has no purchase at or
  after it, over sessions with a cart add;
* ``current_state`` — latest image per key of a change feed, deleted keys
  removed;
* ``snapshot_diff`` — the change records (c / u / d) that turn one snapshot
  into another.

Ordering within a session uses ``ordered_scan`` (a hot session is spread over
several tasks); the rest are partial aggregates or joins on unique keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.ordered import ordered_scan

SESSION_START = "session_start"


def event_transitions(silver: DataFrame) -> DataFrame:
    """from_type, to_type, transitions, probability (share of from_type's
    outgoing transitions); from_type = session_start for a session's first
    event."""
    rows = silver.filter(F.col("event_timestamp").isNotNull()).select(
        "session_id", "event_timestamp", "event_id", "event_type")
    scanned = ordered_scan(rows, "session_id", ["event_timestamp", "event_id"], F.lit(1),
                           lead_of="event_type", count_out="pos", lead_out="next_type")
    pairs = scanned.select(
        F.explode(F.array(
            F.when(F.col("pos") == 1, F.struct(F.lit(SESSION_START).alias("from_type"),
                                               F.col("event_type").alias("to_type"))),
            F.when(F.col("next_type").isNotNull(),
                   F.struct(F.col("event_type").alias("from_type"),
                            F.col("next_type").alias("to_type"))))).alias("p")
    ).filter(F.col("p").isNotNull()).select("p.*")
    counts = pairs.groupBy("from_type", "to_type").agg(F.count(F.lit(1)).alias("transitions"))
    # the per-from_type total is a window over the (small) table of type pairs
    return counts.withColumn(
        "probability",
        F.col("transitions") / F.sum("transitions").over(Window.partitionBy("from_type")))


def session_summary(silver: DataFrame) -> DataFrame:
    return silver.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("events"),
        F.count_distinct(F.when(F.col("event_type") == "add_to_cart", F.col("product_id")))
        .alias("carted_products"))


def cart_abandonment(silver: DataFrame) -> DataFrame:
    t = F.col("event_type")
    per_session = silver.groupBy("session_id").agg(
        F.max(F.when(t == "add_to_cart", F.col("event_timestamp"))).alias("last_cart"),
        F.max(F.when(t == "purchase", F.col("event_timestamp"))).alias("last_purchase"))
    carted = F.col("last_cart").isNotNull()
    abandoned = carted & (F.col("last_purchase").isNull()
                          | (F.col("last_purchase") < F.col("last_cart")))
    return per_session.agg(
        F.count_if(carted).alias("sessions_with_cart"),
        F.count_if(abandoned).alias("abandoned_sessions")
    ).withColumn("abandonment_rate",
                 F.coalesce(F.try_divide(F.col("abandoned_sessions").cast("double"),
                                         F.col("sessions_with_cart").cast("double")), F.lit(0.0)))


def current_state(changes: DataFrame) -> DataFrame:
    """Latest (ts_ms, seq) change per user_id; keys whose latest op is a
    delete are removed.  ``changes``: op, ts_ms, before, after, seq."""
    ev = changes.filter(F.col("op").isin("c", "u", "d", "r")).select(
        F.when(F.col("op") == "d", F.col("before.user_id"))
        .otherwise(F.col("after.user_id")).alias("user_id"),
        "op", "ts_ms", "seq", F.col("after.name").alias("name"),
        F.col("after.email").alias("email")).filter(F.col("user_id").isNotNull())
    latest = ev.groupBy("user_id").agg(
        F.max_by(F.struct("op", "name", "email"), F.struct("ts_ms", "seq")).alias("s"))
    return (latest.filter(F.col("s.op") != "d")
            .select("user_id", F.col("s.name").alias("name"), F.col("s.email").alias("email")))


def snapshot_diff(before: DataFrame, after: DataFrame, key: str = "user_id") -> DataFrame:
    """Change records between two snapshots with one row per key each:
    op c (only in ``after``), d (only in ``before``), u (values differ,
    NULL-safe); unchanged keys are omitted."""
    cols = [c for c in before.columns if c != key]
    b = before.select(key, F.struct(*cols).alias("before"))
    a = after.select(key, F.struct(*cols).alias("after"))
    j = b.join(a, key, "full_outer")
    op = (F.when(F.col("before").isNull(), F.lit("c"))
          .when(F.col("after").isNull(), F.lit("d"))
          .when(~F.col("before").eqNullSafe(F.col("after")), F.lit("u")))
    return j.withColumn("op", op).filter(F.col("op").isNotNull())
