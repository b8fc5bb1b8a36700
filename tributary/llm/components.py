"""Connected components of a link table, by alternating star operations.

Each round replaces links by links to smaller neighbours (large star, then
small star); the number of links never grows and the rounds needed grow with
the logarithm of the component size.  Only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.shared import written


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
    return r[0], r[1]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that some link of ``links`` joins to another
    one; root is the smallest node of its component.  Links to itself, null
    ends and repeated links change nothing; no links give no rows."""
    edges = written(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "cc-links")
    state = _state(edges)
    while True:
        both = edges.select(F.col("hi").alias("x"), F.col("lo").alias("y")).unionAll(
            edges.select(F.col("lo").alias("x"), F.col("hi").alias("y")))
        least = written(both.groupBy("x").agg(F.min("y").alias("m"))
                        .select("x", F.least("x", "m").alias("m")), "cc-least")
        large = written(both.where("y > x").join(least, "x")
                        .select(F.col("y").alias("hi"), F.col("m").alias("lo")).distinct(), "cc-large")
        least = written(large.groupBy("hi").agg(F.min("lo").alias("m")), "cc-least")
        edges = written(
            large.join(least, "hi").where("lo != m")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionAll(least.select("hi", F.col("m").alias("lo"))).distinct(), "cc-links")
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
