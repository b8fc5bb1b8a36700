"""Schema drift: which fields a feed carries that its schema does not name, and
which arrive in another type.

Bronze keeps each record whole as a VARIANT (``payload``) beside the declared
columns, so a field that nobody expected is stored from its first record on and
can be read later, without rewriting a table.  ``drift`` lists the fields that
differ from the schema document, one row per field and type, counted with
partial aggregates: what is shuffled is bounded by the number of different
fields, not of records.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.fixed import CLICKSTREAM_SCHEMA
from tributary.operators.bronze import BRONZE_COLUMNS, CLICKSTREAM_STRUCT, decode_envelope
from tributary.sources.tables import publish

NEW, CHANGED = "new", "changed"
DRIFT = "field string, type string, kind string, rows long, first_seen timestamp, last_seen timestamp"
# levels of nested objects that are looked into
DEPTH = 2


def bronze_with_payload(kafka_df: DataFrame, schema: StructType = CLICKSTREAM_STRUCT,
                        now: Column | None = None) -> DataFrame:
    """Bronze rows (the declared columns and lineage) plus ``payload``, the
    whole record as VARIANT; null where the value is not JSON."""
    decoded = decode_envelope(kafka_df)
    return decoded.select(
        F.inline(F.array(F.struct(F.from_json("value", schema).alias("parsed"),
                                  F.try_parse_json("value").alias("payload")))),
        "kafka_timestamp", F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
        (now if now is not None else F.current_timestamp()).alias("ingestion_timestamp"),
    ).select("parsed.*", *BRONZE_COLUMNS[len(schema.fields):], "payload")


def _class(variant: Column) -> Column:
    """JSON type of a variant: string, integer, number, boolean, null, array or
    object (a number without fraction is an integer, however it is written)."""
    t = F.schema_of_variant(variant)
    return (F.when(t == "VOID", "null").when(t.startswith("OBJECT<"), "object")
            .when(t.startswith("ARRAY<"), "array").when(t.isin("BIGINT") | t.rlike(r"^DECIMAL\(\d+,0\)$"), "integer")
            .when(t.isin("DOUBLE", "FLOAT") | t.startswith("DECIMAL"), "number")
            .otherwise(F.lower(t)))


def fields(bronze: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(field, type, kafka_timestamp): every field of every payload, nested ones
    as ``outer.inner``.  Payloads that are no objects have the field ``$``."""
    spark = bronze.sparkSession
    level = bronze.where("payload is not null").select(
        F.lit("").alias("prefix"), F.col("payload").alias("object"), "kafka_timestamp")
    kind = F.schema_of_variant("object")
    out = level.where(~kind.startswith("OBJECT<")).select(
        F.lit("$").alias("field"), _class(F.col("object")).alias("type"), "kafka_timestamp")
    for _ in range(depth):
        inner = (level.where(kind.startswith("OBJECT<"))
                 .lateralJoin(spark.tvf.variant_explode(F.col("object").outer()))
                 .select(F.concat("prefix", "key").alias("field"), "value", "kafka_timestamp"))
        out = out.unionAll(inner.select("field", _class(F.col("value")).alias("type"), "kafka_timestamp"))
        level = inner.select(F.concat("field", F.lit(".")).alias("prefix"), F.col("value").alias("object"),
                             "kafka_timestamp")
    return out


def declared(document: dict, prefix: str = "") -> dict[str, set[str]]:
    """The fields of a schema document and the types each may have."""
    out: dict[str, set[str]] = {}
    for name, rule in document.get("properties", {}).items():
        kinds = rule.get("type", [])
        kinds = {kinds} if isinstance(kinds, str) else set(kinds)
        if "number" in kinds:
            kinds.add("integer")
        out[prefix + name] = kinds
        out |= declared(rule, f"{prefix}{name}.")
    return out


def drift(bronze: DataFrame, document: dict = CLICKSTREAM_SCHEMA, depth: int = DEPTH) -> DataFrame:
    """field, type, kind (``new``: not declared, ``changed``: in a type that is
    not declared), rows, first_seen and last_seen (record times)."""
    known = declared(document)
    f = F.col("field")
    allowed = F.create_map(*[x for name, kinds in known.items()
                             for x in (F.lit(name), F.array(*map(F.lit, sorted(kinds))))])
    seen = fields(bronze, depth).groupBy("field", "type").agg(
        F.count(F.lit(1)).alias("rows"), F.min("kafka_timestamp").alias("first_seen"),
        F.max("kafka_timestamp").alias("last_seen"))
    kinds = F.try_element_at(allowed, f)
    return (seen.withColumn("kind", F.when(kinds.isNull(), NEW).when(~F.array_contains(kinds, F.col("type")), CHANGED))
            .where("kind is not null").select("field", "type", "kind", "rows", "first_seen", "last_seen"))


def field_of(bronze: DataFrame, path: str, kind: str) -> Column:
    """A field of the stored payloads by its path; null where it is missing or
    has no value of that type."""
    return F.try_variant_get(F.col("payload"), f"$.{path}", kind)


def drift_batch_writer(bronze_path: str, drift_path: str, document: dict = CLICKSTREAM_SCHEMA,
                       now: Column | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: bronze rows with payload, and what drifted among
    them, each as a batch folder, complete and once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, f"batch_id={batch_id}"
        publish(bronze_with_payload(batch, now=now), bronze_path, name)
        # from the stored rows: a repeated batch counts what the first attempt stored
        publish(drift(spark.read.parquet(f"{bronze_path}/{name}"), document).coalesce(1), drift_path, name)
    return write


def drift_so_far(spark: SparkSession, drift_path: str) -> DataFrame:
    """The drift of all batches together."""
    return (spark.read.schema(DRIFT).parquet(drift_path).groupBy("field", "type", "kind")
            .agg(F.sum("rows").alias("rows"), F.min("first_seen").alias("first_seen"),
                 F.max("last_seen").alias("last_seen")))
