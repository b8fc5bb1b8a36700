"""Table sinks and sources (append, overwrite, read, exists, read-or-empty).

The format is a parameter (``parquet`` by default).  Row counts for logs come from ``DataFrame.observe`` during the
write itself, not from a second run of the plan.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)


def _observed_write(df: DataFrame, path: str, mode: str, fmt: str,
                    partition_by: list[str] | None) -> int:
    obs = Observation(f"write-{mode}")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    rows = int(obs.get.get("rows", 0))
    log.info("%s %d rows to %s", "appended" if mode == "append" else "wrote", rows, path)
    return rows


def write_append(df: DataFrame, path: str, fmt: str = "parquet",
                 partition_by: list[str] | None = None) -> int:
    """Append (creates the table when missing); returns the rows written."""
    return _observed_write(df, path, "append", fmt, partition_by)


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet",
                    partition_by: list[str] | None = None) -> int:
    """Replace the table; returns the rows written.  Never point this at a
    table the plan itself reads — write a new snapshot directory instead."""
    return _observed_write(df, path, "overwrite", fmt, partition_by)


def _hadoop(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish(df: DataFrame, root: str, name: str, fmt: str = "parquet",
            notes: dict[str, str] | None = None, options: dict[str, str] | None = None,
            partition_by: list[str] | None = None) -> bool:
    """Write ``df`` as the folder ``root/name`` in one step, once.

    The files are written beside it (a folder that readers ignore) and renamed
    into place when complete; if ``root/name`` is there already, nothing is
    written and False is returned.  So a repeated micro-batch changes nothing,
    and readers never see part of a batch.  ``notes``: small text files
    (``_<key>``) that go with it; ``options`` and ``partition_by`` are the
    writer's.  The rename must be atomic in the file
    system; object stores need a table format with a commit log instead.
    """
    spark = df.sparkSession
    target, fs = _hadoop(spark, f"{root}/{name}")
    if fs.exists(target):
        return False
    staged, _ = _hadoop(spark, f"{root}/_staging/{uuid.uuid4().hex}")
    w = df.write.format(fmt).options(**(options or {}))
    (w.partitionBy(*partition_by) if partition_by else w).save(staged.toString())
    for key, text in (notes or {}).items():
        put_note(spark, staged.toString(), key, text)
    if not fs.rename(staged, target):
        raise OSError(f"could not publish {target.toString()}")
    return True


def publish_notes(spark: SparkSession, root: str, name: str, notes: dict[str, str]) -> bool:
    """A folder ``root/name`` of notes only, in one step, once (see ``publish``)."""
    target, fs = _hadoop(spark, f"{root}/{name}")
    if fs.exists(target):
        return False
    staged, _ = _hadoop(spark, f"{root}/_staging/{uuid.uuid4().hex}")
    for key, text in notes.items():
        put_note(spark, staged.toString(), key, text)
    fs.mkdirs(target.getParent())
    if not fs.rename(staged, target):
        raise OSError(f"could not publish {target.toString()}")
    return True


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in the folder ``path`` (none when it is missing)."""
    hpath, fs = _hadoop(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(hpath)] if fs.exists(hpath) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    hpath, fs = _hadoop(spark, path)
    fs.delete(hpath, True)


def put_note(spark: SparkSession, path: str, key: str, text: str) -> None:
    hpath, fs = _hadoop(spark, f"{path}/_{key}")
    out = fs.create(hpath)
    out.write(bytearray(text.encode()))
    out.close()


def note(spark: SparkSession, path: str, key: str) -> str | None:
    """The text of a note published with the folder ``path``."""
    hpath, fs = _hadoop(spark, f"{path}/_{key}")
    if not fs.exists(hpath):
        return None
    return _read_text(fs, hpath)


def _read_text(fs, hpath) -> str:
    stream = fs.open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | None = None) -> DataFrame:
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """True when ``path`` holds a table: a folder with something that readers
    see (not only hidden files), or a commit log for ``delta``."""
    hpath, fs = _hadoop(spark, path)
    if not fs.exists(hpath):
        return False
    if fmt == "delta":
        return fs.exists(_hadoop(spark, path + "/_delta_log")[0])
    if not fs.getFileStatus(hpath).isDirectory():
        return True
    names = [st.getPath().getName() for st in fs.listStatus(hpath)]
    return any(n == "_SUCCESS" or n[0] not in "_." for n in names)


def read_or_empty(spark: SparkSession, path: str, schema: StructType,
                  fmt: str = "parquet") -> DataFrame:
    """The table at ``path``, or an empty frame of ``schema`` when missing."""
    if table_exists(spark, path, fmt):
        return read_table(spark, path, fmt)
    return spark.createDataFrame([], schema)
