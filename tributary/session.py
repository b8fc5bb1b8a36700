"""Session helpers: the settings the library relies on, and shared storage.

The library never creates its own cluster settings behind the caller's back:
``build_session`` is a convenience for tests, scripts and the benchmark, and
``shared_dir`` only makes a folder of its own for a session in one process
(local tests) that names no checkpoint directory.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package assumes.  Event time is TIMESTAMP in UTC
# (watermarks refuse TIMESTAMP_NTZ), ANSI stays on (the expressions use the
# ``try_*`` forms where bad input must become NULL).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once the data that references them is collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tributary", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = {**DEFAULT_CONF, **REQUIRED_CONF,
            "spark.sql.shuffle.partitions": str(shuffle_partitions)}
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def cluster_conf(total_cores: int, input_split_mb: int = 256) -> dict[str, str]:
    """Suggested settings for a cluster run (pass as ``extra`` or spark-submit
    ``--conf``): about three shuffle partitions per core as the starting
    point, AQE coalescing them to ~128 MB and splitting skewed join
    partitions, input splits of ``input_split_mb``.  Partition sizes then stay
    in executor memory whatever the scale; larger inputs only add tasks."""
    return {
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(input_split_mb * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def ensure_conf(spark: SparkSession) -> None:
    """Apply the settings the library's semantics depend on."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """Root for checkpoints, stream state and hand-over tables.

    This is the shared folder named by ``spark.checkpoint.dir``.  A session
    that names none gets a private temporary folder only if all of it runs in
    one process (``local[...]``); on a cluster that folder would be another one
    on every machine, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — Spark Connect: the server owns the context
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             "executors share")
        root = tempfile.mkdtemp(prefix="tributary-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


# hand-over tables of this process, under every shared folder it has used
_RUN = f"tributary/run-{uuid.uuid4().hex[:12]}"
_USED: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root; removed when the process
    ends (``remove_scratch``)."""
    root = shared_dir(spark)
    _USED[root] = spark
    return f"{root}/{_RUN}/{name}-{uuid.uuid4().hex[:12]}"


@atexit.register
def remove_scratch() -> None:
    """Remove the hand-over tables that this process wrote."""
    for root, spark in list(_USED.items()):
        with contextlib.suppress(Exception):  # a stopped session: nothing to reach it with
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{_RUN}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _USED.pop(root, None)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def materialize(df, name: str = "stored"):
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Used where two branches of a plan must see exactly the same rows with the
    same computed columns (for example a range id assigned after a range
    shuffle), or where a result is read several times: readers prune columns,
    and the copy survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
