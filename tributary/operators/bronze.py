"""Bronze: Kafka envelope → parsed clickstream rows with lineage columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

# FIXED VALUES — the bronze parse schema.  Declared non-null fields come out
# nullable from from_json; malformed JSON yields an all-NULL struct.
CLICKSTREAM_STRUCT = StructType([
    StructField("event_id", StringType(), False),
    StructField("user_id", StringType(), False),
    StructField("timestamp", StringType(), False),
    StructField("event_type", StringType(), False),
    StructField("product_id", StringType(), True),
    StructField("session_id", StringType(), False),
    StructField("metadata", MapType(StringType(), StringType()), True),
])

BRONZE_COLUMNS = [f.name for f in CLICKSTREAM_STRUCT.fields] + [
    "kafka_timestamp", "kafka_partition", "kafka_offset", "ingestion_timestamp"]


def decode_envelope(kafka_df: DataFrame) -> DataFrame:
    """Kafka record → key/value as text, ``timestamp`` renamed kafka_timestamp."""
    return kafka_df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    )


def parse_payload(df: DataFrame, schema: StructType = CLICKSTREAM_STRUCT) -> DataFrame:
    """``value`` JSON → ``parsed`` struct (PERMISSIVE: bad JSON → NULL fields)."""
    return df.withColumn("parsed", F.from_json(F.col("value"), schema))


def flatten_with_lineage(df: DataFrame, now: Column | None = None) -> DataFrame:
    """``parsed.*`` plus Kafka coordinates and the ingestion time.

    The struct is unpacked with ``inline(array(parsed))``, a generator: later
    filters on the parsed fields (silver's required-field check) cannot be
    pushed beneath it, so the optimizer does not copy ``from_json`` into each
    predicate and the JSON is parsed once per record.

    ``current_timestamp()`` is one value per query (per micro-batch on a
    stream); pass ``now`` to pin it.
    """
    return df.select(
        F.inline(F.array("parsed")),
        F.col("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        (now if now is not None else F.current_timestamp()).alias("ingestion_timestamp"),
    )


def process_bronze(kafka_df: DataFrame, now: Column | None = None) -> DataFrame:
    """Envelope decode → JSON parse → flatten.  One narrow stage, no shuffle."""
    return flatten_with_lineage(parse_payload(decode_envelope(kafka_df)), now)


def process_bronze_with_dead_letters(kafka_df: DataFrame, topic: str,
                                     now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Bronze rows plus a dead-letter frame for values that are not JSON.

    By default (``process_bronze``) a malformed value becomes an all-NULL row
    that silver later drops without trace; here it goes to dead letters with
    error ``malformed`` instead.  The second parse only runs for rows whose
    parsed fields are all NULL, so well-formed records pay nothing.
    """
    from functools import reduce

    from tributary.functions.exprs import fence

    stamp = now if now is not None else F.current_timestamp()
    fields = [f.name for f in CLICKSTREAM_STRUCT.fields]
    parsed = parse_payload(decode_envelope(kafka_df))
    flat = parsed.select(F.inline(F.array("parsed")), "value", "kafka_timestamp",
                         F.col("partition").alias("kafka_partition"),
                         F.col("offset").alias("kafka_offset"))
    all_null = reduce(lambda a, b: a & b, [F.col(f).isNull() for f in fields])
    bad = F.when(all_null & F.col("value").isNotNull(),
                 F.try_parse_json(F.col("value")).isNull()).otherwise(F.lit(False))
    flagged = fence(flat.withColumn("__malformed", bad))
    good = (flagged.filter(~F.col("__malformed"))
            .select(*fields, "kafka_timestamp", "kafka_partition", "kafka_offset",
                    stamp.alias("ingestion_timestamp")))
    dead = (flagged.filter(F.col("__malformed"))
            .select(F.col("value").alias("original_event"), F.lit("malformed").alias("error"),
                    F.array(F.lit("malformed")).alias("errors"),
                    F.lit(topic).alias("original_topic"), stamp.alias("timestamp"),
                    F.col("kafka_partition").alias("partition"),
                    F.col("kafka_offset").alias("offset")))
    return good, dead
