"""Data-quality checks per layer, scored in one pass over the data.

A check scores a DataFrame between 0 and 1 and passes when the score reaches
its threshold.  Built-in kinds are aggregate expressions; ``run_checks``
fuses every check of a layer into **one** aggregation (optionally grouped,
e.g. per day, which yields one result per group) and unpivots the scores into
result rows — no per-check actions and nothing collected to the driver.  A
custom check may be a function that returns an aggregate ``Column``, fused like
the others, or one that returns a float, evaluated on its own (the caller's
code decides how it runs; it cannot be grouped).  ``warn_failed`` logs the
checks of stored results that did not pass.

Scores (``total`` = rows; every score is 1.0 on an empty input):

* required_fields — rows where every *present* listed column is non-NULL
  / total (listed columns missing from the frame are skipped);
* null_rate — 1 − NULL cells / (total × present columns); 1.0 when none
  of the columns is present;
* duplicates — distinct values / total, a NULL counting as one value; the
  column must exist;
* timestamp_validity — rows with a non-NULL timestamp not after ``now`` /
  total; 1.0 when the column is missing.
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tributary.fixed import DEFAULT_CHECKS, QUALITY_HISTORY_LIMIT

log = logging.getLogger(__name__)

RESULT_SCHEMA = StructType([
    StructField("check_name", StringType()),
    StructField("layer", StringType()),
    StructField("score", DoubleType()),
    StructField("passed", BooleanType()),
    StructField("record_count", LongType()),
    StructField("details", StringType()),
    StructField("timestamp", TimestampType()),
])


@dataclass
class QualityCheck:
    """A check: ``kind`` + ``fields`` for the built-in kinds, or ``check_fn``
    for custom logic: a ``DataFrame -> Column`` function that returns an
    aggregate expression (it runs in the same pass, per group too), or a
    ``DataFrame -> float`` function, which scores a whole frame."""
    name: str
    layer: str
    threshold: float
    description: str = ""
    kind: str | None = None
    fields: list[str] = field(default_factory=list)
    check_fn: Callable[[DataFrame], Column | float] | None = None


def _ratio(num: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(1.0)).otherwise(num.cast("double") / total.cast("double"))


def score_expr(check: QualityCheck, df: DataFrame, now: Column,
               missing: str = "skip") -> Column:
    """The check's score as one aggregate expression over ``df``.

    ``missing="skip"`` ignores listed columns the frame lacks (a check with
    none left scores 1.0); ``missing="fail"`` scores such a check 0.0.
    """
    total = F.count(F.lit(1))
    present = [f for f in check.fields if f in df.columns]
    if missing == "fail" and len(present) < len(check.fields):
        return F.lit(0.0)
    if check.kind == "required_fields":
        cond = F.lit(True)
        for f in present:
            cond = cond & F.col(f).isNotNull()
        return _ratio(F.count_if(cond), total)
    if check.kind == "null_rate":
        if not present:
            return F.lit(1.0)
        nulls = sum((F.count_if(F.col(f).isNull()) for f in present), F.lit(0))
        return F.when(total == 0, F.lit(1.0)).otherwise(
            1 - nulls.cast("double") / (total * len(present)).cast("double"))
    if check.kind == "duplicates":
        key = F.col(check.fields[0])
        distinct = F.count_distinct(key) + F.when(F.count_if(key.isNull()) > 0, 1).otherwise(0)
        return _ratio(distinct, total)
    if check.kind == "timestamp_validity":
        if not present:
            return F.lit(1.0)
        ts = F.col(present[0])
        return _ratio(F.count_if(ts.isNotNull() & (ts <= now)), total)
    raise ValueError(f"unknown check kind {check.kind!r}")


# Measure columns of each gold table, for per-table completeness checks.
GOLD_MEASURES = {
    "events_per_minute": ["event_count", "unique_users", "unique_sessions"],
    "conversion_rate": ["total_events", "purchases", "add_to_carts", "sessions",
                        "conversion_rate", "cart_to_purchase_rate"],
    "popular_products": ["total_interactions", "views", "cart_adds", "purchases"],
    "active_users_hourly": ["active_users", "total_sessions", "total_events"],
}


def gold_table_checks(threshold: float = 1.0) -> list[QualityCheck]:
    """One completeness check per gold table over its own measure columns,
    layer ``gold.<table>`` (the default gold check only fits one table and
    passes trivially on the others, whose columns it skips)."""
    return [QualityCheck(f"gold_{t}_completeness", f"gold.{t}", threshold,
                         f"Verify {t} measures are non-null", "required_fields", cols)
            for t, cols in GOLD_MEASURES.items()]


class DataQualityChecker:
    """Registry of checks with the default suite pre-registered."""

    def __init__(self, defaults: bool = True,
                 thresholds: dict[str, float] | None = None, missing: str = "skip",
                 per_table_gold: bool = False) -> None:
        if missing not in ("skip", "fail"):
            raise ValueError("missing must be 'skip' or 'fail'")
        self.missing = missing
        self.checks: list[QualityCheck] = []
        if defaults:
            for name, layer, kind, fields, threshold, desc in DEFAULT_CHECKS:
                t = (thresholds or {}).get(name, threshold)
                self.register_check(QualityCheck(name, layer, t, desc, kind, list(fields)))
        if per_table_gold:
            for check in gold_table_checks():
                self.register_check(check)

    def register_check(self, check: QualityCheck) -> None:
        self.checks.append(check)

    def run_checks(self, df: DataFrame, layer: str,
                   now: Column | _dt.datetime | None = None,
                   by: dict[str, Column] | None = None,
                   run_time: Column | None = None) -> DataFrame:
        """Results of every check of ``layer`` on ``df`` (schema RESULT_SCHEMA,
        plus the ``by`` columns when grouping).

        ``now`` bounds timestamp validity and stamps the results; with ``by``
        (name → grouping expression) there is one result per group and check,
        and ``run_time`` (an expression over the ``by`` columns) may give each
        group its own timestamp and validity bound.
        """
        if now is None:
            now_col = F.current_timestamp()
        elif isinstance(now, Column):
            now_col = now
        else:
            now_col = F.lit(now).cast("timestamp")
        checks = [c for c in self.checks if c.layer == layer]
        by = by or {}
        made = {id(c): c.check_fn(df) for c in checks if c.check_fn is not None}
        fused = [c for c in checks if not isinstance(made.get(id(c)), (int, float))]
        custom = [c for c in checks if isinstance(made.get(id(c)), (int, float))]
        if by and custom:
            raise ValueError("a check that returns a float scores the whole frame and cannot be "
                             f"grouped: {', '.join(c.name for c in custom)}; return an aggregate Column")
        stamped = df
        bound = now_col
        if by:
            stamped = df.withColumns(by)
            if run_time is not None:
                stamped = stamped.withColumn("__run", run_time)
                bound = F.col("__run")
        keys = list(by) + (["__run"] if by and run_time is not None else [])

        aggs = [F.count(F.lit(1)).alias("__total")]
        aggs += [(score_expr(c, stamped, bound, self.missing) if c.check_fn is None
                  else F.coalesce(made[id(c)].cast("double"), F.lit(1.0))).alias(f"__s{i}")
                 for i, c in enumerate(fused)]
        grouped = stamped.groupBy(*keys).agg(*aggs) if keys else stamped.agg(*aggs)

        def rows(entries: list[tuple[QualityCheck, Column]]) -> DataFrame:
            """One row per check, from structs: names are values, never SQL."""
            return grouped.select(*keys, "__total", F.inline(F.array(*[
                F.struct(F.lit(c.name).alias("check_name"), F.lit(float(c.threshold)).alias("threshold"),
                         F.lit(str(c.threshold)).alias("threshold_text"),
                         score.cast("double").alias("score")) for c, score in entries])))

        stamp = F.col("__run") if "__run" in keys else now_col
        result_cols = [
            "check_name", F.lit(layer).alias("layer"), "score",
            (F.col("score") >= F.col("threshold")).alias("passed"),
            F.col("__total").alias("record_count"),
            F.concat(F.lit("Threshold: "), F.col("threshold_text")).alias("details"),
            stamp.alias("timestamp"), *by.keys()]

        entries = [(c, F.col(f"__s{i}")) for i, c in enumerate(fused)]
        entries += [(c, F.lit(float(made[id(c)]))) for c in custom]
        if not entries:
            return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
        return rows(entries).select(*result_cols)


def warn_failed(results: DataFrame, limit: int = 20) -> int:
    """Log a warning for each check that did not pass (the first ``limit`` by
    layer and name; the rest are counted); returns how many failed."""
    failed = results.filter(~F.col("passed"))
    n = failed.count()
    for r in failed.orderBy("layer", "check_name", "timestamp").limit(limit).collect():
        log.warning("quality check %s (%s) failed: score %.4f, %s", r.check_name, r.layer, r.score, r.details)
    if n > limit:
        log.warning("%d more quality checks failed", n - limit)
    return n


def quality_history(metrics: DataFrame, check_name: str | None = None,
                    limit: int = QUALITY_HISTORY_LIMIT) -> DataFrame:
    """Newest results first (ties by check name), optionally one check only."""
    if check_name:
        metrics = metrics.filter(F.col("check_name") == check_name)
    return metrics.orderBy(F.col("timestamp").desc(), F.col("check_name")).limit(limit)


def log_results(results: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Append results to the metrics table (one write per run) and warn of
    those of this run that failed."""
    from tributary.sources.tables import write_append

    kept = results.select(*[f.name for f in RESULT_SCHEMA.fields]).persist()
    try:
        rows = write_append(kept, path, fmt)
        warn_failed(kept)
    finally:
        kept.unpersist()
    return rows
