"""Gold: event-time window aggregates over silver, batch or streaming.

Each function takes a silver DataFrame (``event_timestamp`` TIMESTAMP) and
returns one row per window (× key).  ``withWatermark`` is a no-op in batch and
bounds state on a stream.  All measures are partial-aggregable (count, sum,
HLL sketch, avg), so Spark combines on the map side before the shuffle and a
hot key or a hot minute reaches its reducer as one row per map task.

``distinct="approx"`` (default) uses ``approx_count_distinct`` (HLL++,
bounded state, mergeable across tasks); ``distinct="exact"`` uses
``count_distinct`` and is meant for batch verification — on a stream it is
refused, because an exact distinct set is unbounded state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.fixed import (
    WATERMARK_ACTIVE_USERS,
    WATERMARK_CONVERSION_RATE,
    WATERMARK_EVENTS_PER_MINUTE,
    WATERMARK_POPULAR_PRODUCTS,
)
from tributary.functions.exprs import count_when, safe_ratio

TIME = "event_timestamp"


def _distinct(df: DataFrame, col: str, mode: str) -> Column:
    if mode == "approx":
        return F.approx_count_distinct(col)
    if mode == "exact":
        if df.isStreaming:
            raise ValueError("exact distinct counts are unbounded state on a stream; "
                             "use distinct='approx'")
        return F.count_distinct(col)
    raise ValueError(f"distinct must be 'approx' or 'exact', not {mode!r}")


def _timed(df: DataFrame, watermark: str | None) -> DataFrame:
    return df.withWatermark(TIME, watermark) if watermark else df


def events_per_minute(df: DataFrame, watermark: str | None = WATERMARK_EVENTS_PER_MINUTE,
                      distinct: str = "approx") -> DataFrame:
    """Tumbling 1 minute × event_type: events, distinct users and sessions."""
    return (
        _timed(df, watermark)
        .groupBy(F.window(TIME, "1 minute"), "event_type")
        .agg(F.count(F.lit(1)).alias("event_count"),
             _distinct(df, "user_id", distinct).alias("unique_users"),
             _distinct(df, "session_id", distinct).alias("unique_sessions"))
        .select(F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"),
                "event_type", "event_count", "unique_users", "unique_sessions")
    )


def conversion_rate(df: DataFrame, watermark: str | None = WATERMARK_CONVERSION_RATE,
                    distinct: str = "approx") -> DataFrame:
    """Tumbling 5 minutes: totals, purchases / sessions, purchases / carts.

    A rate is 0.0 when its denominator is 0.
    """
    t = F.col("event_type")
    agg = (
        _timed(df, watermark)
        .groupBy(F.window(TIME, "5 minutes"))
        .agg(F.count(F.lit(1)).alias("total_events"),
             count_when(t == "purchase").alias("purchases"),
             count_when(t == "add_to_cart").alias("add_to_carts"),
             _distinct(df, "session_id", distinct).alias("sessions"))
    )
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "total_events", "purchases", "add_to_carts", "sessions",
        safe_ratio(F.col("purchases"), F.col("sessions")).alias("conversion_rate"),
        safe_ratio(F.col("purchases"), F.col("add_to_carts")).alias("cart_to_purchase_rate"),
    )


def _product_measures(t: Column, revenue: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("total_interactions"),
            count_when(t == "page_view").alias("views"),
            count_when(t == "add_to_cart").alias("cart_adds"),
            count_when(t == "purchase").alias("purchases"),
            F.sum(revenue).alias("total_revenue")]


def popular_products(df: DataFrame, watermark: str | None = WATERMARK_POPULAR_PRODUCTS,
                     method: str = "panes") -> DataFrame:
    """Sliding 1 hour every 5 minutes × product_id (rows with a product only).

    total_revenue sums cart_value of every interaction (carts and purchases)
    and is NULL when all are NULL.

    ``method="expand"``: Spark's sliding ``window`` — each event is expanded
    into its 12 windows before the partial aggregate.
    ``method="panes"`` (default): aggregate 5-minute panes first, then slide
    the panes (all measures are additive).  The 12× expansion then applies to
    pane rows instead of events, of which a (pane, product) holds many at scale.
    """
    src = _timed(df.filter(F.col("product_id").isNotNull()), watermark)
    t = F.col("event_type")
    if method == "expand":
        agg = src.groupBy(F.window(TIME, "1 hour", "5 minutes"), "product_id") \
                 .agg(*_product_measures(t, F.col("cart_value")))
    elif method == "panes":
        panes = src.groupBy(F.window(TIME, "5 minutes").alias("pane"), "product_id").agg(
            F.count(F.lit(1)).alias("n"),
            count_when(t == "page_view").alias("v"),
            count_when(t == "add_to_cart").alias("c"),
            count_when(t == "purchase").alias("p"),
            F.sum("cart_value").alias("r"))
        agg = panes.groupBy(F.window(F.window_time("pane"), "1 hour", "5 minutes"),
                            "product_id").agg(
            F.sum("n").alias("total_interactions"), F.sum("v").alias("views"),
            F.sum("c").alias("cart_adds"), F.sum("p").alias("purchases"),
            F.sum("r").alias("total_revenue"))
    else:
        raise ValueError(f"method must be 'expand' or 'panes', not {method!r}")
    return agg.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"),
                      "product_id", "total_interactions", "views", "cart_adds",
                      "purchases", "total_revenue")


def active_users_hourly(df: DataFrame, watermark: str | None = WATERMARK_ACTIVE_USERS,
                        distinct: str = "approx") -> DataFrame:
    """Tumbling 1 hour: distinct users, sessions, events, mean non-NULL cart value."""
    return (
        _timed(df, watermark)
        .groupBy(F.window(TIME, "1 hour"))
        .agg(_distinct(df, "user_id", distinct).alias("active_users"),
             _distinct(df, "session_id", distinct).alias("total_sessions"),
             F.count(F.lit(1)).alias("total_events"),
             F.avg("cart_value").alias("avg_cart_value"))
        .select(F.col("window.start").alias("hour_start"),
                F.col("window.end").alias("hour_end"),
                "active_users", "total_sessions", "total_events", "avg_cart_value")
    )


GOLD_TABLES = {
    "events_per_minute": events_per_minute,
    "conversion_rate": conversion_rate,
    "popular_products": popular_products,
    "active_users_hourly": active_users_hourly,
}
