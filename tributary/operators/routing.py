"""Validation, partition keys and dead-letter routing of raw JSON records.

One frame of raw records in, violations computed once per record, then two
filters: accepted records (keyed for their topic) and dead letters (an
envelope with the original text and the reasons).  On a stream, run
``route`` inside one ``foreachBatch`` and write both outputs from the same
persisted batch (see ``tributary.streaming``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.fixed import UNKNOWN_KEY
from tributary.functions.exprs import fence
from tributary.functions.jsonrules import with_violations

ROUTE_SENT = "sent"
ROUTE_DLQ = "dlq"


def _image(field: str) -> str:
    """user_id of a state image, if that is an object that is not empty."""
    at = f"try_variant_get(__doc, '$.{field}', 'variant')"
    return (f"WHEN schema_of_variant({at}) LIKE 'OBJECT<%' AND schema_of_variant({at}) <> 'OBJECT<>' "
            f"THEN try_variant_get(__doc, '$.{field}.user_id', 'string')")


# Partition keys as expressions over the parsed document.
KEYS = {
    "clickstream": f"coalesce(try_variant_get(__doc, '$.user_id', 'string'), '{UNKNOWN_KEY}')",
    "cdc": f"coalesce(CASE {_image('after')} {_image('before')} END, '{UNKNOWN_KEY}')",
}


def validate(df: DataFrame, schema: dict, value_col: str = "value",
             key: str | None = None) -> DataFrame:
    """Adds ``errors ARRAY<STRING>``, ``error`` (the first) and ``route``; with
    ``key`` ("clickstream" or "cdc") also ``route_key``, the partition key, from
    the same parse of the document."""
    text = F.col(value_col).cast("string")
    also = {"route_key": KEYS[key]} if key else None
    checked = fence(with_violations(df, text, schema, "errors", also))
    return checked.withColumns({
        "error": F.get(F.col("errors"), 0),
        "route": F.when(F.size("errors") == 0, F.lit(ROUTE_SENT)).otherwise(F.lit(ROUTE_DLQ)),
    })


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("route") == ROUTE_SENT)


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("route") == ROUTE_DLQ)


def clickstream_key(text: Column) -> Column:
    """Partition key of a clickstream record: its user_id, else "unknown"."""
    return F.coalesce(F.get_json_object(text, "$.user_id"), F.lit(UNKNOWN_KEY))


def with_cdc_key(df: DataFrame, value_col: str = "value", out: str = "key") -> DataFrame:
    """Adds the partition key of a change record.

    The state image is ``after`` when it is a non-empty object, else
    ``before`` when that is a non-empty object; the key is that image's
    user_id, "unknown" when there is no image or it has no user_id.  The
    document is parsed once (staged projections).
    """
    staged = df.withColumn("__doc", F.try_parse_json(F.col(value_col).cast("string")))
    staged = staged.withColumns({
        "__after": F.try_variant_get("__doc", "$.after", "variant"),
        "__before": F.try_variant_get("__doc", "$.before", "variant")})
    staged = staged.withColumns({
        "__ka": F.schema_of_variant("__after"), "__kb": F.schema_of_variant("__before")})

    def non_empty_object(kind: str) -> Column:
        return F.coalesce(F.col(kind).startswith("OBJECT<") & (F.col(kind) != "OBJECT<>"),
                          F.lit(False))

    uid = (F.when(non_empty_object("__ka"), F.try_variant_get("__after", "$.user_id", "string"))
           .when(non_empty_object("__kb"), F.try_variant_get("__before", "$.user_id", "string")))
    return (staged.withColumn(out, F.coalesce(uid, F.lit(UNKNOWN_KEY)))
            .drop("__doc", "__after", "__before", "__ka", "__kb"))


def keyed_for_topic(accepted_df: DataFrame, topic: str, key: Column,
                    value_col: str = "value") -> DataFrame:
    """Accepted records as Kafka sink rows: key, value, topic."""
    return accepted_df.select(key.alias("key"), F.col(value_col).cast("string").alias("value"),
                              F.lit(topic).alias("topic"))


def dlq_envelope(rejected_df: DataFrame, original_topic: str | Column,
                 now: Column | _dt.datetime | None = None, value_col: str = "value") -> DataFrame:
    """Dead letters: original_event, error, errors, original_topic, timestamp."""
    if now is None:
        now_col = F.current_timestamp()
    elif isinstance(now, Column):
        now_col = now
    else:
        now_col = F.lit(now).cast("timestamp")
    topic = original_topic if isinstance(original_topic, Column) else F.lit(original_topic)
    keep = [c for c in ("partition", "offset") if c in rejected_df.columns]
    return rejected_df.select(
        F.col(value_col).cast("string").alias("original_event"),
        "error", "errors", topic.alias("original_topic"), now_col.alias("timestamp"), *keep)


def observed_routes(validated: DataFrame, name: str = "routes") -> DataFrame:
    """Attach sent / dlq counters to a (streaming) frame: the values appear in
    each micro-batch's query progress under ``observedMetrics[name]``."""
    return validated.observe(name,
                             F.count_if(F.col("route") == ROUTE_SENT).alias("sent"),
                             F.count_if(F.col("route") == ROUTE_DLQ).alias("dlq"))


def routing_metrics(validated: DataFrame, group: str | None = "topic") -> DataFrame:
    """Records sent and dead-lettered (per ``group`` when given).

    A Spark sink retries failed tasks instead of counting send failures, so
    there is no "failed" counter.
    """
    aggs = [F.count_if(F.col("route") == ROUTE_SENT).alias("sent"),
            F.count_if(F.col("route") == ROUTE_DLQ).alias("dlq")]
    return validated.groupBy(group).agg(*aggs) if group else validated.agg(*aggs)
