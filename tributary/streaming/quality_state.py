"""Quality scores kept up to date from states: a new day costs one day.

Every batch of a layer leaves one small row per partition (a day, say) and
check: how many rows or cells were good, out of how many.  Counts of several
batches add up, so the score of a partition, also one that got rows in several
batches, and of the whole layer are sums over these rows; the data behind them
is not read again.

Duplicates do not add up: what counts is how many keys are new.  The keys seen
are kept in an id table (``streaming.idtable``: buckets, sorted, bloom filters),
once per partition and once for the layer; a batch looks up its own keys and
its state is the number of new ones, so these states add up too, exactly.

    root/states/batch_id=<n>/   states of a batch
    root/ids-<scope>/           keys seen, per partition or in the layer
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.quality import DataQualityChecker, QualityCheck
from tributary.session import materialize
from tributary.sources.tables import publish
from tributary.streaming import idtable as I

STATES = ("part string, check_name string, scope string, good long, cells long, rows long, has_null boolean, "
          "batch_id int")
PART, LAYER, BOTH = "part", "layer", "both"
_SEPARATOR = "\u0001"


def _counts(check: QualityCheck, df: DataFrame, bound: Column) -> tuple[Column, Column]:
    """Good cells and all cells of a check whose counts add up."""
    total = F.count(F.lit(1))
    present = [f for f in check.fields if f in df.columns]
    if check.kind == "required_fields":
        whole = F.lit(True)
        for f in present:
            whole = whole & F.col(f).isNotNull()
        return F.count_if(whole), total
    if check.kind == "null_rate":
        filled = sum((F.count(f) for f in present), F.lit(0).cast("long"))
        return filled, total * len(present)
    if check.kind == "timestamp_validity":
        if not present:
            return total, total
        ts = F.col(present[0])
        return F.count_if(ts.isNotNull() & (ts <= bound)), total
    raise ValueError(f"counts of {check.kind!r} do not add up")


def _additive(df: DataFrame, checks: list[QualityCheck], bound: Column) -> DataFrame:
    """One pass over the batch: a row per partition and check."""
    pairs = [_counts(c, df, bound) for c in checks]
    sums = df.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), *[
        x.cast("long").alias(f"{name}{i}") for i, pair in enumerate(pairs) for name, x in zip("gc", pair, strict=True)])
    return sums.select("part", "rows", F.inline(F.array(*[
        F.struct(F.lit(c.name).alias("check_name"), F.lit(BOTH).alias("scope"), F.col(f"g{i}").alias("good"),
                 F.col(f"c{i}").alias("cells"), F.lit(False).alias("has_null")) for i, c in enumerate(checks)])))


def _new_keys(spark: SparkSession, keyed: DataFrame, path: str, batch_id: int, scope: str) -> DataFrame:
    """part and event_id (the key under its scope) of keys not seen before."""
    key = F.col("key") if scope == LAYER else F.concat(F.coalesce("part", F.lit("")), F.lit(_SEPARATOR), "key")
    rows = keyed.where("key is not null").select("part", key.alias(I.ID))
    # a key that is new to the layer counts for one partition only
    rows = rows.groupBy(I.ID).agg(F.min("part").alias("part"))
    known = I.known_ids(spark, path, rows.select(I.ID), batch_id)
    return rows if known is None else rows.join(known, I.ID, "left_anti")


def add_batch(spark: SparkSession, root: str, df: DataFrame, layer: str, part: Column, batch_id: int,
              bound: Column, checker: DataQualityChecker | None = None, buckets: int = I.ID_BUCKETS) -> bool:
    """States of a batch of ``layer``, once (a repeated batch changes nothing).
    ``part``: the partition of a row (text); ``bound``: up to when a time is
    valid, an expression over the row and ``part``.  Checks with a function of
    their own have no states and are left out."""
    checks = [c for c in (checker or DataQualityChecker()).checks if c.layer == layer and c.kind]
    fields = [f for f in dict.fromkeys(f for c in checks for f in c.fields) if f in df.columns]
    named = df.withColumn("part", part.cast("string"))
    rows = materialize(named.withColumn("__bound", bound).select("part", "__bound", *fields), "quality-batch")
    states = None
    plain = [c for c in checks if c.kind != "duplicates"]
    if plain:
        states = _additive(rows, plain, F.col("__bound"))
    later: list[tuple[DataFrame, str]] = []
    for c in (c for c in checks if c.kind == "duplicates"):
        keyed = rows.select("part", F.col(c.fields[0]).cast("string").alias("key"))
        totals = keyed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"),
                                           (F.count_if(F.col("key").isNull()) > 0).alias("has_null"))
        for scope in (PART, LAYER):
            path = f"{root}/ids-{scope}/{c.name}"
            new = materialize(_new_keys(spark, keyed, path, batch_id, scope), f"quality-new-{scope}")
            fresh = new.groupBy("part").agg(F.count(F.lit(1)).alias("good"))
            mine = totals.join(fresh, "part", "left").select(
                "part", "rows", F.lit(c.name).alias("check_name"), F.lit(scope).alias("scope"),
                F.coalesce("good", F.lit(0)).cast("long").alias("good"), F.col("rows").alias("cells"), "has_null")
            states = mine if states is None else states.unionByName(mine)
            later.append((new.select(I.ID), path))
    if states is None:
        return False
    done = publish(states.coalesce(1), f"{root}/states", f"batch_id={batch_id}")
    for ids, path in later:
        I.publish_ids(ids, path, f"batch_id={batch_id}", I.buckets_of(spark, path, buckets))
    return done


def scores(spark: SparkSession, root: str, layer: str, checker: DataQualityChecker | None = None,
           by_part: bool = True) -> DataFrame:
    """check_name, layer, score, passed, record_count, details, and part with
    ``by_part`` (else of the layer as a whole), from the states alone."""
    checks = [c for c in (checker or DataQualityChecker()).checks if c.layer == layer and c.kind]
    rules = spark.createDataFrame([(c.name, float(c.threshold), str(c.threshold), c.kind) for c in checks],
                                  "check_name string, threshold double, text string, kind string")
    keys = ["part"] if by_part else []
    states = spark.read.schema(STATES).parquet(f"{root}/states").where(
        F.col("scope").isin(BOTH, PART if by_part else LAYER))
    sums = states.groupBy("check_name", *keys).agg(
        F.sum("good").alias("good"), F.sum("cells").alias("cells"), F.sum("rows").alias("rows"),
        F.max("has_null").alias("has_null"))
    # a null key is one value
    good = F.col("good") + F.when(F.col("has_null"), 1).otherwise(0)
    score = F.when(F.col("cells") == 0, 1.0).otherwise(good.cast("double") / F.col("cells"))
    return (sums.join(rules, "check_name").withColumn("score", score)
            .select(*keys, "check_name", F.lit(layer).alias("layer"), "score",
                    (F.col("score") >= F.col("threshold")).alias("passed"), F.col("rows").alias("record_count"),
                    F.concat(F.lit("Threshold: "), "text").alias("details")))


def quality_batch_writer(spark: SparkSession, root: str, layer: str, part: Column, bound: Column,
                         checker: DataQualityChecker | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch body: states of every batch of a layer's stream."""
    def write(batch: DataFrame, batch_id: int) -> None:
        add_batch(spark, root, batch, layer, part, batch_id, bound, checker)
    return write
