"""Monitoring queries over the gold and quality-metrics tables.

Each function is a small Spark query (one-row aggregates, top-k, ordered
series) returning a DataFrame; nothing is collected here.  Loaders return an
empty frame of the declared schema when a table does not exist yet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.fixed import QUALITY_LOADER_LIMIT, TOP_PRODUCTS_N


# --- loaders (S17) ---------------------------------------------------------

def load_or_empty(spark: SparkSession, path: str, schema: StructType,
                  fmt: str = "parquet") -> DataFrame:
    from tributary.sources.tables import read_or_empty

    return read_or_empty(spark, path, schema, fmt)


def latest_quality(metrics: DataFrame, limit: int = QUALITY_LOADER_LIMIT) -> DataFrame:
    """The newest ``limit`` quality results (ties by check name)."""
    return metrics.orderBy(F.col("timestamp").desc(), F.col("check_name")).limit(limit)


def events_by_window(epm: DataFrame) -> DataFrame:
    return epm.orderBy("window_start", "event_type")


def conversions_by_window(conv: DataFrame) -> DataFrame:
    return conv.orderBy("window_start")


def products_by_revenue(pop: DataFrame) -> DataFrame:
    return pop.orderBy(F.col("total_revenue").desc_nulls_last(), "product_id", "window_start")


# --- overview (A8, L4) -----------------------------------------------------

def overview(epm: DataFrame, conv: DataFrame, quality: DataFrame,
             since: Column | None = None) -> DataFrame:
    """One row: total_events, conversion_rate (latest window, %), avg_quality
    (%), failed_checks; zeros when a source is empty.

    ``total_events`` sums every window unless ``since`` (a timestamp
    expression) bounds it, e.g. ``current_timestamp() - INTERVAL 1 HOUR`` for
    an "events in the last hour" figure.  The three sources are tagged and
    unioned, then reduced by one aggregate.
    """
    if since is not None:
        epm = epm.filter(F.col("window_start") >= since)
    null_t = F.lit(None).cast("timestamp")
    parts = [
        epm.select(F.lit("e").alias("src"), F.col("event_count").cast("double").alias("x"),
                   null_t.alias("at"), F.lit(None).cast("boolean").alias("ok")),
        conv.select(F.lit("c").alias("src"), F.col("conversion_rate").alias("x"),
                    F.col("window_start").alias("at"), F.lit(None).cast("boolean").alias("ok")),
        quality.select(F.lit("q").alias("src"), F.col("score").alias("x"), null_t.alias("at"),
                       F.col("passed").alias("ok")),
    ]
    tagged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    src = F.col("src")
    return tagged.agg(
        F.coalesce(F.sum(F.when(src == "e", F.col("x"))), F.lit(0.0)).cast("bigint")
        .alias("total_events"),
        F.coalesce(F.max_by(F.when(src == "c", F.col("x")), F.when(src == "c", F.col("at"))) * 100,
                   F.lit(0.0)).alias("conversion_rate"),
        F.coalesce(F.avg(F.when(src == "q", F.col("x"))) * 100, F.lit(0.0)).alias("avg_quality"),
        F.count_if((src == "q") & ~F.col("ok")).alias("failed_checks"),
    ).select("total_events", "conversion_rate", "avg_quality", "failed_checks")


# --- quality views (A9, X3, X4) --------------------------------------------

def quality_by_layer(quality: DataFrame) -> DataFrame:
    return quality.groupBy("layer").agg(F.avg("score").alias("score"))


def failed_checks(quality: DataFrame) -> DataFrame:
    return quality.filter(~F.col("passed")).select("check_name", "layer", "score", "timestamp")


def score_trend(quality: DataFrame) -> DataFrame:
    return quality.select("timestamp", "score", "check_name").orderBy("timestamp", "check_name")


# --- business series (X5, X6, L1, A10) -------------------------------------

def throughput_series(epm: DataFrame) -> DataFrame:
    return epm.select("window_start", "event_count", "event_type") \
              .orderBy("window_start", "event_type")


def conversion_series(conv: DataFrame) -> DataFrame:
    return conv.select("window_start", "conversion_rate").orderBy("window_start")


def top_products(pop: DataFrame, n: int = TOP_PRODUCTS_N) -> DataFrame:
    """Products by summed total_revenue of the gold table, top ``n``.

    The gold table holds overlapping sliding windows, so one interaction is
    counted in up to 12 windows; ``top_products_from_silver`` sums each
    interaction once.  Ties go to the smaller product_id.
    """
    return (pop.groupBy("product_id")
            .agg(F.coalesce(F.sum("total_revenue"), F.lit(0.0)).alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc(), "product_id")
            .limit(n))


def top_products_from_silver(silver: DataFrame, n: int = TOP_PRODUCTS_N) -> DataFrame:
    return (silver.filter(F.col("product_id").isNotNull())
            .groupBy("product_id")
            .agg(F.coalesce(F.sum("cart_value"), F.lit(0.0)).alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc(), "product_id")
            .limit(n))
