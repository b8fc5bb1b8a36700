"""Gold tables kept up to date with new silver rows, window by window.

``store_gold`` writes a gold table partitioned by the day of its windows.  When
rows come later (a late batch, a backfilled range), ``refresh_gold`` derives the
windows that they touch, reads only the silver rows of those windows, and
replaces only the days that hold them (dynamic partition overwrite); untouched
windows of such a day are carried over from the stored table, all other days
keep their files.  Repeating a refresh that failed half-way gives the same
table.

The driver learns the days that are touched, nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.timeparse import micros_of
from tributary.operators.gold import GOLD_TABLES, TIME
from tributary.operators.silver import EVENT_DATE, with_event_date
from tributary.session import materialize
from tributary.sources.tables import read_table, write_append, write_overwrite

DAY = "day"


@dataclass(frozen=True)
class Windowing:
    size: str
    slide: str
    start: str                  # column of the window's start
    needs: str | None = None    # column without which a row touches no window


WINDOWS = {
    "events_per_minute": Windowing("1 minute", "1 minute", "window_start"),
    "conversion_rate": Windowing("5 minutes", "5 minutes", "window_start"),
    "popular_products": Windowing("1 hour", "5 minutes", "window_start", "product_id"),
    "active_users_hourly": Windowing("1 hour", "1 hour", "hour_start"),
}


def _floor(time: Column, step: int) -> Column:
    at = F.unix_micros(time)
    return at - F.pmod(at, F.lit(step))


def touched_windows(rows: DataFrame, table: str) -> DataFrame:
    """(start, day): the windows of ``table`` that hold any of ``rows``."""
    w = WINDOWS[table]
    size, slide = micros_of(w.size), micros_of(w.slide)
    rows = rows.where(F.col(TIME).isNotNull())
    if w.needs:
        rows = rows.where(F.col(w.needs).isNotNull())
    # one row per pane before it spreads over its windows
    panes = rows.select(_floor(F.col(TIME), slide).alias("pane")).distinct()
    starts = F.explode(F.sequence(F.col("pane") - F.lit(size - slide), "pane", F.lit(slide)))
    return (panes.select(starts.alias("at")).distinct().select(F.timestamp_micros("at").alias("start"))
            .withColumn(DAY, F.to_date("start")))


def _compute(table: str, silver: DataFrame, distinct: str) -> DataFrame:
    kwargs = {} if table == "popular_products" else {"distinct": distinct}
    return GOLD_TABLES[table](silver, watermark=None, **kwargs)


def _placed(gold: DataFrame, start: str) -> DataFrame:
    """By day, dealt to tasks in ranges of time, so that a large day is
    several files."""
    return gold.withColumn(DAY, F.to_date(start)).repartitionByRange(DAY, start)


def store_gold(silver: DataFrame, table: str, path: str, distinct: str = "approx") -> int:
    """The whole gold table, partitioned by day."""
    return write_overwrite(_placed(_compute(table, silver, distinct), WINDOWS[table].start), path,
                           partition_by=[DAY])


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path).drop(DAY)


def append_silver(rows: DataFrame, path: str) -> int:
    """More silver rows, partitioned by the date of their event time."""
    return write_append(with_event_date(rows), path, partition_by=[EVENT_DATE])


def refresh_gold(spark: SparkSession, table: str, silver_path: str, new_rows: DataFrame, path: str,
                 distinct: str = "approx") -> list:
    """Bring the gold table at ``path`` up to date after ``new_rows`` were added
    to the silver table at ``silver_path`` (partitioned by date); returns the
    days replaced.  Rows without an event time touch nothing."""
    w = WINDOWS[table]
    size, slide = micros_of(w.size), micros_of(w.slide)
    dirty = materialize(touched_windows(new_rows, table), "dirty-windows")
    days = sorted(r[DAY] for r in dirty.select(DAY).distinct().collect())
    if not days:
        return []
    # the panes that dirty windows are made of, and the silver rows in them
    begin = F.unix_micros("start")
    panes = dirty.select(F.explode(F.sequence(begin, begin + F.lit(size - slide), F.lit(slide))).alias("pane")).distinct()
    first, last = dirty.agg(F.to_date(F.min("start")), F.to_date(F.timestamp_micros(F.max(begin) + size))).first()
    silver = (read_table(spark, silver_path).where(F.col(EVENT_DATE).between(first, last))
              .withColumn("pane", _floor(F.col(TIME), slide)).join(panes, "pane", "left_semi")
              .drop("pane", EVENT_DATE))
    starts = dirty.select(F.col("start").alias(w.start))
    fresh = _compute(table, silver, distinct).join(starts, w.start, "left_semi")
    kept = read_table(spark, path).where(F.col(DAY).isin(days)).drop(DAY).join(starts, w.start, "left_anti")
    # written beside the table before any of its files goes
    whole = materialize(kept.unionByName(fresh), f"refresh-{table}")
    (_placed(whole, w.start).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(DAY).parquet(path))
    return days
