"""Per-key ordered scans that do not put a hot key into one task.

``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one
task; when one key holds a large share of the data that task does a large
share of the job.  ``ordered_scan`` computes the two per-key ordered values
the library needs — a running count of flagged rows and the next row's order
value (``lead``) — without that:

1. range-partition on (key, order): a hot key's rows are spread over several
   contiguous ranges, each of bounded size;
2. within each (range, key) group — bounded by the range size — compute the
   local running count and local lead with ordinary window functions;
3. summarise each (range, key) group to one row (count, first order value);
   a key has at most one summary row per range, so the per-key window over
   the summary is bounded by the number of ranges;
4. join the summary back on (range, key): running count = preceding ranges'
   total + local count; the last row of a group takes the next group's first
   order value as its lead.

Range boundaries come from Spark's range partitioner, which samples its
input; the rows with their range id are therefore written once, as Parquet in
the shared folder (``session.materialize``), and both the scan and the summary
read that copy, so they agree on every id, also after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.session import materialize

PID = "__range"


def ordered_scan(df: DataFrame, key: str, order: list[str], flag: Column | str,
                 lead_of: str, count_out: str = "running_count",
                 lead_out: str = "next_value", partitions: int | None = None,
                 key_offsets: DataFrame | None = None) -> DataFrame:
    """Add ``count_out`` (inclusive running count of ``flag`` rows per key, in
    ``order``) and ``lead_out`` (``lead_of`` of the next row of the key, NULL
    on the key's last row).  ``lead_of`` must be non-NULL.  Rows with equal
    (key, order) values must not occur, or their relative order is
    unspecified (add a tie-break column).

    ``key_offsets`` (columns: key, ``offset``; one row per key) adds a per-key
    starting value to the count; it is joined to the per-range summary, never
    to the rows themselves, so a hot key does not skew that join either.
    """
    flag_col = F.col(flag) if isinstance(flag, str) else flag
    # The range id is computed once and materialised: a range partitioner
    # samples its input, so two evaluations of the same exchange could draw
    # different boundaries; both branches below must see the same ids.
    src = df.withColumn("__flag", flag_col.cast("int"))
    # Without an explicit count AQE may coalesce neighbouring ranges (small
    # inputs); a coalesced read keeps the ranges contiguous and in order, so
    # the ids stay monotone in the sort order.
    ranged = (src.repartitionByRange(partitions, key, *order) if partitions
              else src.repartitionByRange(key, *order))
    staged = materialize(ranged.withColumn(PID, F.spark_partition_id()), "ranges")

    local = Window.partitionBy(PID, key).orderBy(*order)
    scanned = staged.withColumns({
        "__lc": F.sum("__flag").over(local.rowsBetween(Window.unboundedPreceding, 0)),
        "__ln": F.lead(lead_of).over(local),
    })

    # a group's total and first value stand in its last and first row of the
    # same window, so the summary shares the scan's shuffle
    summary = (scanned.select(PID, key, "__lc", "__ln", F.col(lead_of).alias("__v"),
                              F.row_number().over(local).alias("__rn"))
               .filter((F.col("__rn") == 1) | F.col("__ln").isNull())
               .groupBy(PID, key)
               .agg(F.max(F.when(F.col("__ln").isNull(), F.col("__lc"))).alias("__cnt"),
                    F.max(F.when(F.col("__rn") == 1, F.col("__v"))).alias("__first")))
    across = Window.partitionBy(key).orderBy(PID)
    summary = summary.select(
        PID, key,
        F.coalesce(F.sum("__cnt").over(across.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__before"),
        F.lead("__first").over(across).alias("__next_first"))
    if key_offsets is not None:
        summary = (summary.join(key_offsets.select(key, F.col("offset").alias("__off")), key, "left")
                   .withColumn("__before", F.col("__before") + F.coalesce(F.col("__off"), F.lit(0)))
                   .drop("__off"))

    joined = scanned.join(summary, [PID, key], "inner")
    return (joined
            .withColumns({
                count_out: F.col("__before") + F.col("__lc"),
                lead_out: F.coalesce(F.col("__ln"), F.col("__next_first")),
            })
            .drop(PID, "__flag", "__lc", "__ln", "__before", "__next_first"))
