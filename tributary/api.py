"""Class-style entry points for users switching from a class-based pipeline.

Every method delegates to the DataFrame functions of this package; state
lives in tables (dimension snapshots, quality metrics), never in the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.fixed import TOPIC_CLICKSTREAM
from tributary.operators import gold as G
from tributary.operators import quality as Q
from tributary.operators import routing as R
from tributary.operators import scd2 as C
from tributary.operators import silver as S
from tributary.operators.bronze import process_bronze
from tributary.plans import backfill as BF
from tributary.sources import kafka as K
from tributary.sources import tables as T
from tributary.streaming import jobs as J


class SilverTransformations:
    clean_strings = staticmethod(S.clean_strings)
    deduplicate_events = staticmethod(S.deduplicate_events)
    parse_timestamp = staticmethod(S.parse_timestamp)
    extract_metadata = staticmethod(S.extract_metadata)
    add_derived_columns = staticmethod(S.add_derived_columns)
    validate_required_fields = staticmethod(S.validate_required_fields)


process_silver = S.process_silver


class GoldAggregations:
    events_per_minute = staticmethod(G.events_per_minute)
    conversion_rate = staticmethod(G.conversion_rate)
    popular_products = staticmethod(G.popular_products)
    active_users_hourly = staticmethod(G.active_users_hourly)


class TableWriter:
    """Append / overwrite / read / exists on a table format (parquet default)."""

    def __init__(self, spark: SparkSession, fmt: str = "parquet") -> None:
        self.spark, self.fmt = spark, fmt

    def write_append(self, df: DataFrame, path: str) -> int:
        return T.write_append(df, path, self.fmt)

    def write_overwrite(self, df: DataFrame, path: str) -> int:
        return T.write_overwrite(df, path, self.fmt)

    def read_table(self, path: str) -> DataFrame:
        return T.read_table(self.spark, path, self.fmt)

    def table_exists(self, path: str) -> bool:
        return T.table_exists(self.spark, path, self.fmt)


class CDCHandler:
    """SCD-2 user dimension kept as numbered snapshots under ``user_dim_path``
    (``snapshot=0`` from ``initialize_dimension_table``, one more per
    ``apply_cdc_batch``); ``read()`` returns the newest complete one."""

    def __init__(self, spark: SparkSession, user_dim_path: str, fmt: str = "parquet") -> None:
        self.spark, self.path, self.fmt = spark, user_dim_path.rstrip("/"), fmt

    def _latest(self) -> str | None:
        return J.latest_snapshot(self.spark, self.path)

    def read(self) -> DataFrame:
        latest = self._latest()
        if latest is None:
            raise ValueError(f"Dimension table not found at {self.path}")
        return self.spark.read.format(self.fmt).load(latest)

    def initialize_dimension_table(self, initial_df: DataFrame,
                                   now: Column | _dt.datetime | None = None) -> None:
        if self._latest() is not None:
            raise ValueError(f"Dimension table exists at {self.path}")
        T.publish(C.initialize_dimension(initial_df, now), self.path, "snapshot=0", self.fmt)

    def apply_cdc_batch(self, cdc_df: DataFrame, now: Column | _dt.datetime | None = None,
                        **kw) -> str:
        return J.next_snapshot(self.spark, self.path, cdc_df, fmt=self.fmt, now=now, **kw)


class QualityMetricsStore:
    """Quality results appended to a metrics table; history read back."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet") -> None:
        self.spark, self.path, self.fmt = spark, path, fmt

    def log(self, results: DataFrame) -> int:
        return Q.log_results(results, self.path, self.fmt)

    def get_quality_history(self, check_name: str | None = None, limit: int = 100) -> DataFrame:
        metrics = T.read_or_empty(self.spark, self.path, Q.RESULT_SCHEMA, self.fmt)
        return Q.quality_history(metrics, check_name, limit)


DataQualityChecker = Q.DataQualityChecker
QualityCheck = Q.QualityCheck


class BackfillManager:
    """Replays a topic (Kafka, or a landed copy with Kafka's columns) through
    bronze, silver and gold under ``bronze_path`` with ``/bronze`` replaced
    by ``/backfill``."""

    def __init__(self, spark: SparkSession, bronze_path: str, topic: str = TOPIC_CLICKSTREAM,
                 bootstrap: str | None = None, partitions: K.Partitions | None = None) -> None:
        self.spark, self.bronze_path, self.topic = spark, bronze_path, topic
        self.bootstrap, self.partitions = bootstrap, partitions

    def get_starting_offsets(self, offset: int | None = None,
                             timestamp: _dt.datetime | None = None) -> dict[str, str]:
        return K.starting_options(self.topic, self._named(), offset, timestamp)

    def get_ending_offsets(self, end_offset: int | None = None) -> dict[str, str]:
        return K.ending_options(self.topic, self._named(), end_offset)

    def _named(self) -> K.Partitions:
        if self.partitions is None:
            raise ValueError("name the topic's partitions (their number, or a list)")
        return self.partitions

    def read_kafka_batch(self, starting: dict[str, str], ending: dict[str, str]) -> DataFrame:
        if not self.bootstrap:
            raise ValueError("no Kafka bootstrap servers configured")
        return K.read_kafka_batch(self.spark, self.bootstrap, self.topic, starting, ending)

    def full_backfill(self, source: DataFrame, start_offset=None,
                      start_timestamp: _dt.datetime | None = None,
                      distinct: str = "approx") -> dict[str, str]:
        return BF.full_backfill(self.spark, source, BF.backfill_base(self.bronze_path),
                                start_offset, start_timestamp, distinct)


class EventRouter:
    """Validation and dead-letter routing of raw JSON records."""

    def __init__(self, schema: dict, topic: str) -> None:
        self.schema, self.topic = schema, topic

    def route(self, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(accepted rows keyed for the topic, dead-letter envelopes).

        Both frames derive from one validation; writing both evaluates it
        twice unless ``raw`` is persisted first (the streaming router,
        ``streaming.jobs.start_router``, persists each micro-batch itself).
        """
        checked = R.validate(raw, self.schema)
        ok = R.keyed_for_topic(R.accepted(checked), self.topic,
                               R.clickstream_key(F.col("value").cast("string")))
        return ok, R.dlq_envelope(R.rejected(checked), self.topic)


__all__ = ["SilverTransformations", "process_silver", "GoldAggregations", "TableWriter",
           "CDCHandler", "QualityMetricsStore", "DataQualityChecker", "QualityCheck",
           "BackfillManager", "EventRouter", "process_bronze"]
