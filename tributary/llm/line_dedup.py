"""Line deduplication by overlapping three-line windows.

Every run of three consecutive lines (blank lines do not count) is hashed; a
window seen before - earlier in the same document, or in a document with a
smaller id - is a later occurrence, and the lines that later occurrences cover
are removed.  Overlapping windows merge by position, so a repeated passage of
any length from three lines goes whole, and its first occurrence stays.
Repeated passages that lie in fewer than three whole lines, or begin and end
inside lines, are not found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.exprs import fence
from tributary.llm.shared import written

WINDOW = 3
_WORD = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _solid(lines: Column) -> Column:
    """Positions of the lines that hold a word."""
    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).rlike(_WORD))


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, body, at, window): the 128-bit hash of each window and the
    number of its first line among the lines that hold a word.  ``body`` tells
    texts apart that share a doc_id."""
    hashed = (docs.select("doc_id", F.xxhash64("text").alias("body"), _lines(F.col("text")).alias("lines"))
              .select("doc_id", "body",
                      F.transform(F.filter("lines", lambda x: x.rlike(_WORD)), lambda x: F.md5(x)).alias("h")))
    runs = F.transform(
        F.sequence(F.lit(0), F.size("h") - WINDOW),
        lambda i: F.struct(i.alias("at"), F.unhex(F.md5(F.concat(
            *[F.get(F.col("h"), i + k) for k in range(WINDOW)]))).alias("window")))
    return fence(hashed).select("doc_id", "body", F.inline(F.when(F.size("h") >= WINDOW, runs)))


def covered(docs: DataFrame) -> DataFrame:
    """(doc_id, body, starts): where later occurrences begin, per document."""
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "body", "at")
    all_windows = windows(docs).select("window", place.alias("place"))
    repeated = written(
        all_windows.groupBy("window").agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .where("first != last").select("window", "first"), "line-windows")
    return written(
        all_windows.join(repeated, "window").where("place > first")
        .groupBy("place.doc_id", "place.body").agg(F.collect_set("place.at").alias("starts")),
        "line-covered")


def line_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` stripped of repeated passages, plus ``n_lines``
    (lines with a word, before) and ``n_removed``; columns of these names are
    replaced, all others kept.

    Texts of fewer than three lines with a word have no window and stay; null
    and empty texts too.  Blank lines are never removed.  Rows that repeat a
    whole document (same doc_id and text) are the same document: they are
    treated alike, not as occurrences of each other.  Documents with a null
    doc_id come last, in the order of a hash of their text.
    """
    extra = docs.drop("n_lines", "n_removed")
    starts = covered(extra.select("doc_id", "text")).select(
        F.col("doc_id").alias("_id"), F.col("body").alias("_body"), F.col("starts").alias("_starts"))
    # the covered places grow with the corpus, so the plan is the same at any
    # size: both sides meet by document
    joined = extra.withColumn("_key", F.xxhash64("text")).join(
        starts.hint("merge"), (F.col("_key") == F.col("_body")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    lines, solid = F.col("_lines"), F.col("_solid")
    gone = F.array_distinct(F.flatten(F.transform(
        "_starts", lambda s: F.array(*[F.get(solid, s + k) for k in range(WINDOW)]))))
    rest = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    # each fence keeps a caller's filter on the results from being moved below,
    # where it would evaluate the nested expressions once per line
    parts = fence(joined.withColumn("_lines", _lines(F.col("text")))).withColumn("_solid", _solid(lines))
    found = fence(fence(parts).withColumn("_gone", F.coalesce(gone, F.array().cast("array<int>"))))
    return fence(
        found.withColumn("n_lines", F.size(solid).cast("long"))
        .withColumn("n_removed", F.size("_gone").cast("long"))
        .withColumn("text", F.when(F.size("_gone") > 0, F.array_join(
            F.transform(rest, lambda i: F.get(lines, i)), "\n")).otherwise(F.col("text")))
        .select(*extra.columns, "n_lines", "n_removed"))


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return line_dedup(docs.select("doc_id", "text"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
s AS (
  SELECT *, list_filter(range(1, len(lines) + 1),
                        lambda i: regexp_matches(lines[i], '[^\x20\x09-\x0D]')) AS solid FROM d),
w AS (
  SELECT doc_id, j, lines[solid[j]] || chr(10) || lines[solid[j + 1]] || chr(10) || lines[solid[j + 2]] AS win
  FROM (SELECT *, unnest(range(1, len(solid) - 1)) AS j FROM s)),
o AS (SELECT doc_id, j, row_number() OVER (PARTITION BY win ORDER BY doc_id, j) AS nth FROM w),
g AS (
  SELECT doc_id, list_distinct(flatten(list([j, j + 1, j + 2]))) AS gone FROM o WHERE nth > 1 GROUP BY doc_id),
r AS (
  SELECT s.*, list_transform(coalesce(gone, []), lambda k: solid[k]) AS cut FROM s LEFT JOIN g USING (doc_id))
SELECT doc_id,
       CASE WHEN len(cut) = 0 THEN text
            ELSE array_to_string(list_transform(list_filter(range(1, len(lines) + 1),
                                                lambda i: NOT list_contains(cut, i)), lambda i: lines[i]), chr(10))
       END AS text,
       CAST(len(solid) AS BIGINT) AS n_lines, CAST(len(cut) AS BIGINT) AS n_removed
FROM r
"""
