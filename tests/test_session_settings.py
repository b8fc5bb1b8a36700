"""Results do not depend on the session zone or on ANSI mode."""

import datetime as dt

from pyspark.sql import functions as F

from tributary.functions.timeparse import parse_event_time
from tributary.plans import catalog as C

SF = "/root/testdata/sf0.001"


def test_zone_designators_give_the_instant(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-01-01T12:00:00.000000Z",), ("2024-01-01T14:00:00+02:00",)],
                                   "t string")
        micros = [r.m for r in df.select(F.unix_micros(parse_event_time(F.col("t"))).alias("m"))
                  .collect()]
        want = int(dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
        assert micros == [want, want]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_queries_independent_of_zone_and_ansi(spark):
    base = {n: _rows(C.QUERIES[n](spark, SF)) for n in ("silver_full", "conversion_rate")}
    old_tz = spark.conf.get("spark.sql.session.timeZone")
    old_ansi = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        for n, rows in base.items():
            assert _rows(C.QUERIES[n](spark, SF)) == rows  # queries pin UTC themselves
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old_tz)
        spark.conf.set("spark.sql.ansi.enabled", old_ansi)


def test_shared_dir_reads_the_session_setting(spark):
    from tributary.session import cluster_conf, scratch_path, shared_dir

    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getCheckpointDir()
    root = shared_dir(spark)
    assert configured and configured.rstrip("/").endswith(root.split(":", 1)[-1].rstrip("/"))
    assert scratch_path(spark, "x").startswith(root + "/tributary/run-")
    conf = cluster_conf(4000)
    assert int(conf["spark.sql.shuffle.partitions"]) >= 12000
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert conf["spark.cleaner.referenceTracking.cleanCheckpoints"] == "true"


def test_no_private_folder_on_a_cluster():
    import pytest

    from tributary.session import shared_dir

    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
