"""The stream's id table: buckets, files and row groups that a lookup opens."""

import pytest
from pyspark.sql import functions as F

from tributary.session import scratch_path
from tributary.streaming import idtable as I


@pytest.fixture(scope="module")
def table(spark):
    path = scratch_path(spark, "ids")
    n = I.buckets_of(spark, path, 8)
    for batch in range(3):
        ids = spark.range(batch * 10_000, (batch + 1) * 10_000).select(F.concat(F.lit("e"), "id").alias("event_id"))
        assert I.publish_ids(ids, path, f"batch_id={batch}", n)
    return path


def ids_of(spark, numbers):
    return spark.createDataFrame([(f"e{i}",) for i in numbers], "event_id string")


def scan_metric(df, name):
    """A metric of the (one) file scan of an executed plan."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    stack = [leaves.apply(i) for i in range(leaves.length())]
    total = 0
    while stack:
        node = stack.pop()
        if node.nodeName().startswith(("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage",
                                       "AdaptiveSparkPlan")):
            inner = node.executedPlan() if node.nodeName().startswith("Adaptive") else node.plan()
            more = inner.collectLeaves()
            stack += [more.apply(i) for i in range(more.length())]
        elif node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply(name).value()
    return total


def test_number_of_buckets_is_kept(spark, table):
    assert I.buckets_of(spark, table, 99) == 8
    assert I.publish_ids(ids_of(spark, [1]), table, "batch_id=0", 8) is False


def test_lookup_equals_plain_join(spark, table):
    for numbers in ([], [5], [5, 5, 40_000], range(29_000, 31_000)):
        for point in (0, 256):
            got = I.lookup(I.stored_ids(spark, table), ids_of(spark, numbers), 8, point).collect()
            assert sorted(r.event_id for r in got) == sorted({f"e{i}" for i in numbers if i < 30_000})
    assert I.known_ids(spark, table, ids_of(spark, [10_001]), 1).count() == 0
    assert I.known_ids(spark, table, ids_of(spark, [10_001]), 2).count() == 1
    assert I.known_ids(spark, scratch_path(spark, "none"), ids_of(spark, [1]), 1) is None


def test_a_batch_opens_only_its_buckets(spark, table):
    every = scan_metric(I.stored_ids(spark, table).select("event_id"), "numFiles")
    few = ids_of(spark, [3, 12_345])
    at = {r.b for r in few.select(I.bucket_of(F.col("event_id"), 8).alias("b")).collect()}
    per_bucket = every / 8
    for point in (0, 256):
        out = I.lookup(I.stored_ids(spark, table), few, 8, point)
        assert scan_metric(out, "numFiles") == per_bucket * len(at)


def test_bloom_filters_skip_row_groups(spark, table):
    """An id between the smallest and largest of every file, but in none."""
    absent = spark.createDataFrame([("e12345x",)], "event_id string")
    out = I.lookup(I.stored_ids(spark, table), absent, 8)
    assert scan_metric(out, "numFiles") == 3 and scan_metric(out, "numOutputRows") == 0
    # the rows are there when the filter does not know the id
    spark.conf.set("spark.sql.parquet.filterPushdown", "false")
    try:
        assert scan_metric(I.lookup(I.stored_ids(spark, table), absent, 8), "numOutputRows") > 3000
    finally:
        spark.conf.unset("spark.sql.parquet.filterPushdown")


def test_files_are_sorted_and_have_bloom_filters(spark, table):
    files = [r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(table).select("path").collect()]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for f in files[:4]:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(f), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            assert reader.getRowGroups().get(0).getColumns().get(0).getBloomFilterOffset() > 0
        finally:
            reader.close()
        ids = [r.event_id for r in spark.read.parquet(f).collect()]
        assert ids == sorted(ids)
