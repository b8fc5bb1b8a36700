"""Replay history through bronze, silver and gold as batch jobs.

Each layer is its own job joined through storage (like the streaming
layers), so a failure reruns one layer, not the whole chain; every write is
an overwrite of a directory owned by this run.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession

from tributary.operators.bronze import process_bronze
from tributary.operators.gold import GOLD_TABLES
from tributary.operators.silver import EVENT_DATE, process_silver, with_event_date
from tributary.sources.kafka import replay_range
from tributary.sources.tables import read_table, write_overwrite


def backfill_bronze(source: DataFrame, output_path: str, start_offset=None,
                    start_timestamp: _dt.datetime | None = None, end_offset=None,
                    now: Column | None = None, fmt: str = "parquet") -> int:
    """Bounded read of raw records → parsed bronze rows → overwrite.

    ``source`` is a bounded Kafka read or a landed copy of the topic (Kafka's
    columns); the range is applied with Kafka's rules (``replay_range``).
    """
    raw = replay_range(source, start_offset, start_timestamp, end_offset)
    return write_overwrite(process_bronze(raw, now), output_path, fmt)


def backfill_silver(spark: SparkSession, bronze_path: str, output_path: str,
                    fmt: str = "parquet", partition_by_date: bool = False) -> int:
    """Silver from the stored bronze.  ``partition_by_date`` writes it
    partitioned by ``event_date`` for time-bounded readers (they then prune
    whole directories); the full-table gold backfill gains nothing from it."""
    silver = process_silver(read_table(spark, bronze_path, fmt))
    if partition_by_date:
        return write_overwrite(with_event_date(silver), output_path, fmt,
                               partition_by=[EVENT_DATE])
    return write_overwrite(silver, output_path, fmt)


def backfill_gold(spark: SparkSession, silver_path: str, output_base: str,
                  distinct: str = "approx", fmt: str = "parquet") -> dict[str, str]:
    """All four gold tables from one silver table (each read prunes its own
    columns from the stored table)."""
    silver = read_table(spark, silver_path, fmt)
    paths = {}
    for name, fn in GOLD_TABLES.items():
        kwargs = {} if name == "popular_products" else {"distinct": distinct}
        paths[name] = f"{output_base}/{name}"
        write_overwrite(fn(silver, **kwargs), paths[name], fmt)
    return paths


def full_backfill(spark: SparkSession, source: DataFrame, base: str, start_offset=None,
                  start_timestamp: _dt.datetime | None = None, distinct: str = "approx",
                  now: Column | None = None, fmt: str = "parquet") -> dict[str, str]:
    """bronze → silver → gold under ``base``; returns the layer paths."""
    paths = {"bronze": f"{base}/bronze", "silver": f"{base}/silver", "gold": f"{base}/gold"}
    backfill_bronze(source, paths["bronze"], start_offset, start_timestamp, now=now, fmt=fmt)
    backfill_silver(spark, paths["bronze"], paths["silver"], fmt)
    backfill_gold(spark, paths["silver"], paths["gold"], distinct, fmt)
    return paths


def backfill_base(bronze_path: str) -> str:
    """Backfill root next to the live bronze table: ``…/bronze`` → ``…/backfill``."""
    return bronze_path.replace("/bronze", "/backfill")

