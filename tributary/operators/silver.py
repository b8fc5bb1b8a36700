"""Silver: required-field filter, dedup, typed timestamp, flat metadata,
normalised keys and business flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.fixed import CLEANED_COLUMNS, METADATA_STRING_KEYS, SILVER_REQUIRED
from tributary.functions.timeparse import parse_event_time

DEDUP_ORDER = ["kafka_timestamp", "kafka_partition", "kafka_offset"]
EVENT_DATE = "event_date"


def with_event_date(df: DataFrame) -> DataFrame:
    """Adds ``event_date`` (UTC date of event_timestamp), the partition column
    of stored silver tables."""
    return df.withColumn(EVENT_DATE, F.to_date("event_timestamp"))


def clean_strings(df: DataFrame, columns: list[str]) -> DataFrame:
    """``trim(lower(c))`` for each column (trim strips spaces only)."""
    return df.withColumns({c: F.trim(F.lower(F.col(c))) for c in columns})


def deduplicate_events(df: DataFrame, key: str = "event_id",
                       order: list[str] | None = None) -> DataFrame:
    """Keep the earliest record per ``key``.

    Earliest = smallest ``kafka_timestamp``; ties go to the lower partition,
    then the lower offset, so the result is deterministic.  ``row_number() = 1``
    is planned with a partial WindowGroupLimit before the shuffle: every map
    task keeps one row per key, so a key with very many copies does not reach
    one reducer whole.
    """
    order = [c for c in (order or DEDUP_ORDER) if c in df.columns]
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def parse_timestamp(df: DataFrame, strict: bool = False) -> DataFrame:
    """``timestamp`` text → ``event_timestamp`` TIMESTAMP; drops ``timestamp``."""
    return df.withColumn("event_timestamp", parse_event_time(F.col("timestamp"), strict)) \
             .drop("timestamp")


def extract_metadata(df: DataFrame) -> DataFrame:
    """Flatten the metadata map; a missing key gives NULL.

    cart_value → DOUBLE; quantity → INT through DOUBLE (so ``"2.7"`` → 2,
    as a legacy cast would give); unreadable text → NULL.
    """
    m = F.col("metadata")
    cols = {k: m.getItem(k) for k in METADATA_STRING_KEYS}
    cols["cart_value"] = m.getItem("cart_value").try_cast("double")
    cols["quantity"] = m.getItem("quantity").try_cast("double").try_cast("int")
    return df.withColumns(cols).drop("metadata")


def add_derived_columns(df: DataFrame) -> DataFrame:
    """is_conversion = purchase; is_cart_event = add_to_cart or purchase."""
    t = F.col("event_type")
    return df.withColumns({
        "is_conversion": F.coalesce(t == "purchase", F.lit(False)),
        "is_cart_event": F.coalesce(t.isin("add_to_cart", "purchase"), F.lit(False)),
    })


def validate_required_fields(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Drop rows where any required field is NULL (pushed into the scan)."""
    return df.dropna(how="any", subset=required or SILVER_REQUIRED)


def process_silver(bronze: DataFrame, strict_timestamp: bool = False,
                   dedup: bool = True) -> DataFrame:
    """required → dedup → timestamp → metadata → clean keys → flags.

    Dedup runs before the keys are cleaned, as specified; pass
    ``dedup=False`` when the caller deduplicates itself (streams).
    """
    df = validate_required_fields(bronze)
    if dedup:
        df = deduplicate_events(df)
    return (df.transform(lambda d: parse_timestamp(d, strict_timestamp))
              .transform(extract_metadata)
              .transform(lambda d: clean_strings(d, CLEANED_COLUMNS))
              .transform(add_derived_columns))
