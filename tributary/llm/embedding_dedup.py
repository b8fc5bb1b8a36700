"""Near-duplicate vectors by NN-descent.

A neighbour graph is started from random-hyperplane buckets and refined by
comparing neighbours of neighbours: every vector's list, together with the
vectors that list it, is a small group whose members are compared with each
other, and each keeps its best.  Edges at or over the threshold make
components.  Lists that are full of such edges are too short: links that they
had no room for are looked for in other buckets, between components only, until
none is found; and the members of a component get the whole component as their
list, compared exactly in blocks.  An audit compares bounded samples (of all
vectors, of those in large buckets, and one of each of the largest components)
with all vectors; below the wanted recall the graph is built further from other
buckets, and at last the labels concerned are compared block by block, exactly.

Vectors are compared only within a label and of the same length, by cosine in
double precision.  Identical vectors are one vector from the start, counted as
often as it occurs.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.components import components
from tributary.llm.shared import extended, written

NEIGHBOURS = 8
TABLES = 6              # bucketings that start the graph
BUCKET = 64             # vectors wanted in a bucket
GROUP = 256             # a larger bucket is dealt into groups of about this size
HUB = 64                # a larger list of neighbours too
BLOCK = 512             # vectors of a block of a component
TASK_ROWS = 2000
ROUNDS = 3              # refinements at most
TURNS = 3
AUDIT = 200             # vectors of each sample compared with all others by the audit
RECALL = 0.995

_log = logging.getLogger(__name__)


def usable(rows: DataFrame) -> DataFrame:
    """(id, label, emb) of the vectors that can have links, one row per id."""
    emb = F.col("embedding").cast("array<double>")
    bad = F.exists(emb, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.aggregate(emb, F.lit(0.0), lambda s, x: s + x * x)
    return (rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
            .where(~bad & (norm > 0))
            .groupBy(F.col("vec_id").alias("id"))
            .agg(F.min(F.struct("label", F.col("embedding").alias("emb"))).alias("v"))
            .select("id", F.concat_ws("/", F.col("v.label").cast("string"), F.size("v.emb")).alias("label"),
                    "v.emb"))


def _classes(vectors: DataFrame) -> DataFrame:
    """(one, two, rep, copies): the classes of identical vectors by their two
    hashes, with the smallest id of each."""
    return vectors.groupBy("one", "two").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))


def _matrix(col) -> np.ndarray:
    """Unit vectors, in double precision, of a list column of equal lengths."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    x = np.asarray(col.flatten(), dtype=np.float64).reshape(len(col), -1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _codes(emb: list, table: int, bits: int) -> np.ndarray:
    """Side of ``bits`` random hyperplanes, as a number."""
    x = np.asarray(emb, dtype=np.float64)
    planes = np.random.Generator(np.random.PCG64([table, x.shape[1]])).standard_normal((x.shape[1], bits))
    return ((x @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64))).astype(np.int64)


def _dealt(rows: DataFrame, key: list[str], size: int, member: str, name: str, seed: int = 0) -> DataFrame:
    """``rows`` with ``sub``: groups of one key, split into about ``size`` rows.
    Each key, and each ``seed``, deals the same members differently."""
    parts = written(rows.groupBy(*key).agg(F.ceil(F.count("*") / size).alias("parts")), name)
    deal = f"pmod(xxhash64({member}, {', '.join(key)}, {11 + seed}), parts)"
    return rows.join(parts, key).withColumn("sub", F.expr(deal)).drop("parts")


def _tasks(rows: DataFrame, key: list[str], n: int) -> DataFrame:
    count = 1 + n // TASK_ROWS
    return rows.withColumn("task", F.expr(f"pmod(xxhash64({', '.join(key)}), {count})"))


def _groups(table: pa.Table, key: list[str]) -> Iterator[np.ndarray]:
    """Row numbers of each group of ``key`` in a task's table."""
    codes = [np.unique(np.asarray(table[k]), return_inverse=True)[1] for k in key]
    order = np.lexsort(codes[::-1])
    cuts = np.zeros(max(len(order) - 1, 0), dtype=bool)
    for c in codes:
        cuts |= np.diff(c[order]) != 0
    return iter(np.split(order, np.flatnonzero(cuts) + 1))


def _best(table: pa.Table, key: list[str], k: int) -> pa.Table:
    """For every member of every group, its ``k`` nearest others of the group."""
    ids = np.asarray(table["id"])
    emb = table["emb"].combine_chunks()
    left, right, near = [], [], []
    for rows in _groups(table, key):
        if len(rows) < 2:
            continue
        x = _matrix(emb.take(pa.array(rows)))
        cos = x @ x.T
        np.fill_diagonal(cos, -2)
        top = min(k, len(rows) - 1)
        at = np.argpartition(-cos, top - 1, axis=1)[:, :top]
        left.append(np.repeat(ids[rows], top))
        right.append(ids[rows][at].ravel())
        near.append(np.take_along_axis(cos, at, axis=1).ravel())
    cat = lambda a, t: np.concatenate(a) if a else np.empty(0, t)
    return pa.table({"id": pa.array(cat(left, np.int64)), "other": pa.array(cat(right, np.int64)),
                     "cos": pa.array(cat(near, np.float64))})


def _across(table: pa.Table, key: list[str], threshold: float) -> pa.Table:
    """Of every group, links between different components (column ``root``): as
    many as join what is linked, not all pairs."""
    ids, root = np.asarray(table["id"]), np.asarray(table["root"])
    emb = table["emb"].combine_chunks()
    left, right = [], []
    for rows in _groups(table, key):
        x, of = _matrix(emb.take(pa.array(rows))), root[rows]
        link, own = x @ x.T >= threshold, of[:, None] == of[None, :]
        if not (link & ~own).any():
            continue
        link |= own
        new = np.ones(len(rows), dtype=bool)
        for first in range(len(rows)):
            open_ = [first] if new[first] else []
            new[first] = False
            while open_:
                a = open_.pop()
                found = np.flatnonzero(link[a] & new)
                new[found] = False
                open_ += found.tolist()
                found = found[of[found] != of[a]]
                left.append(np.repeat(ids[rows[a]], len(found)))
                right.append(ids[rows[found]])
    cat = lambda a: np.concatenate(a).astype(np.int64) if a else np.empty(0, np.int64)
    return pa.table({"id": pa.array(cat(left)), "other": pa.array(cat(right))})


_EDGE = "id long, other long, cos double"
_LINK = "id long, other long"


def _lists(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` best edges of each vector."""
    once = edges.groupBy("id", "other").agg(F.max("cos").alias("cos"))
    best = once.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("cos", "other")), False).alias("l"))
    return best.select("id", F.inline(F.slice("l", 1, k))).select("id", "other", "cos")


def _coded(vectors: DataFrame, n: int, tables: range) -> DataFrame:
    """``vectors`` with their bucket (``code``) in each of ``tables``."""
    labels = vectors.agg(F.count_distinct("label")).first()[0] or 1
    bits = max(0, math.ceil(math.log2(max(1.0, n / (labels * BUCKET)))))

    def run(batches):
        for b in batches:
            emb = b.column("emb")
            size = np.asarray(emb.value_lengths())
            for t in tables:
                code = np.zeros(len(size), dtype=np.int64)
                for d in np.unique(size):
                    at = np.flatnonzero(size == d)
                    code[at] = _codes(np.asarray(emb.take(pa.array(at)).flatten()).reshape(len(at), d), t, bits)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(np.full(len(size), t, dtype=np.int64)), pa.array(code)],
                    names=[*b.schema.names, "tbl", "code"])

    return vectors.mapInArrow(run, extended(vectors, tbl="long", code="long"))


_BUCKET = ["tbl", "label", "code"]


def _buckets(vectors: DataFrame, n: int, tables: range):
    """The vectors by task; ``sub`` and _BUCKET tell the groups apart."""
    coded = _dealt(_coded(vectors, n, tables), _BUCKET, GROUP, "id", "nn-buckets")
    return _tasks(coded, [*_BUCKET, "sub"], n * len(tables)).groupBy("task")


def _start(vectors: DataFrame, n: int, tables: range, k: int) -> DataFrame:
    grouped = _buckets(vectors, n, tables)
    return _lists(grouped.applyInArrow(lambda t: _best(t, [*_BUCKET, "sub"], k), _EDGE), k)


def _rooted(vectors: DataFrame, roots: DataFrame) -> DataFrame:
    """``vectors`` with the ``root`` of their component, if only themselves."""
    return vectors.join(roots.withColumnRenamed("node", "id"), "id", "left").select(
        "id", "label", "emb", F.coalesce("root", "id").alias("root"))


def _merged(vectors: DataFrame, links: DataFrame, n: int, threshold: float, seeds: Iterator[int]) -> DataFrame:
    """``links`` and those between their components that are found in other
    buckets; every search takes new ones, until one finds nothing (each before
    it joined components, so there is an end)."""
    while True:
        roots = written(components(links, "id", "other"), "nn-roots")
        first = next(seeds) * TABLES
        grouped = _buckets(_rooted(vectors, roots), n, range(first, first + TABLES))
        more = written(grouped.applyInArrow(
            lambda t: _across(t, [*_BUCKET, "sub"], threshold), _LINK).distinct(), "nn-across")
        if more.isEmpty():
            return links
        links = links.unionAll(more)


def _exact(vectors: DataFrame, links: DataFrame, labels: list[str], threshold: float) -> DataFrame:
    """``links`` and all that is missing between their components in ``labels``:
    every block of a label meets every other."""
    roots = written(components(links, "id", "other"), "nn-roots")
    some = written(_rooted(vectors, roots).where(F.col("label").isin(labels)), "nn-exact")
    parts = some.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    placed = some.join(F.broadcast(parts), "label").withColumn(
        "block", F.expr("cast(pmod(xxhash64(id, 17), parts) as int)"))
    pairs = placed.select("id", "label", "emb", "root", "block",
                          F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with"))
    pairs = pairs.select("id", "label", "emb", "root", F.least("block", "with").alias("b1"),
                         F.greatest("block", "with").alias("b2"))
    key = ["label", "b1", "b2"]
    n = pairs.select("id").count()
    found = _tasks(pairs, key, n).groupBy("task").applyInArrow(lambda t: _across(t, key, threshold), _LINK)
    return links.unionAll(written(found.distinct(), "nn-across"))


def _refined(vectors: DataFrame, graph: DataFrame, n: int, k: int, seed: int) -> DataFrame:
    """One round: neighbours of neighbours, in both directions."""
    around = graph.select(F.col("id").alias("hub"), F.col("other").alias("id")).unionAll(
        graph.select(F.col("other").alias("hub"), "id")).distinct()
    dealt = _dealt(written(around, "nn-around"), ["hub"], HUB, "id", "nn-hubs", seed)
    # the hub itself belongs to each part of its list
    own = dealt.select("hub", F.col("hub").alias("id"), "sub").distinct()
    members = dealt.select("hub", "id", "sub").unionAll(own).join(vectors.select("id", "emb"), "id")
    grouped = _tasks(members, ["hub", "sub"], n * 2 * k).groupBy("task")
    found = grouped.applyInArrow(lambda t: _best(t, ["hub", "sub"], k), _EDGE)
    return _lists(found.unionAll(graph), k)


def _count_links(vectors: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """(id, n_links): every member of a component against the whole component,
    block by block; a linked vector counts as often as it has copies."""
    parts = written(roots.groupBy("root").agg(F.count("*").alias("size"), F.ceil(F.count("*") / BLOCK)
                    .cast("int").alias("parts")), "nn-parts")
    placed = written(roots.join(parts, "root").withColumn("block", F.expr("cast(pmod(xxhash64(node, 13), parts) as int)")),
                     "nn-placed")
    # a block meets every block of its component once
    pairs = placed.select(
        F.col("node").alias("id"), "root", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with"))
    pairs = pairs.select("id", "root", "block", F.least("block", "with").alias("b1"), F.greatest("block", "with").alias("b2"))
    n = pairs.count()

    def run(table: pa.Table) -> pa.Table:
        ids, block = np.asarray(table["id"]), np.asarray(table["block"])
        emb, copies = table["emb"].combine_chunks(), np.asarray(table["copies"])
        who, many = [], []
        for rows in _groups(table, ["root", "b1", "b2"]):
            x, side = _matrix(emb.take(pa.array(rows))), block[rows]
            one, two = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
            link = x[one] @ x[two].T >= threshold
            if side.min() == side.max():
                if np.asarray(table["b1"])[rows[0]] != np.asarray(table["b2"])[rows[0]]:
                    continue    # the other block is empty
                np.fill_diagonal(link, False)
                who.append(ids[rows][one])
                many.append(link @ copies[rows][two])
            else:
                who += [ids[rows][one], ids[rows][two]]
                many += [link @ copies[rows][two], copies[rows][one] @ link]
        cat = lambda a: np.concatenate(a).astype(np.int64) if a else np.empty(0, np.int64)
        return pa.table({"id": pa.array(cat(who)), "n": pa.array(cat(many))})

    rows = _tasks(pairs.join(vectors.select("id", "emb", "copies"), "id"), ["root", "b1", "b2"], n)
    counts = rows.groupBy("task").applyInArrow(run, "id long, n long")
    return counts.groupBy("id").agg(F.sum("n").alias("n_links"))


def _samples(vectors: DataFrame, links: DataFrame, roots: DataFrame, n: int, size: int) -> DataFrame:
    """(id, stratum): ``size`` vectors at most of all, of those in buckets over
    GROUP, and of components, the largest first."""
    coded = _coded(vectors.select("id", "label", "emb"), n, range(1)).select("id", "label", "code")
    large = coded.groupBy("label", "code").count().where(F.col("count") > GROUP).drop("count")
    crowded = coded.join(large, ["label", "code"]).select("id")
    drawn = [(name, rows.orderBy(F.xxhash64("id"), "id").limit(size))
             for name, rows in [("all", vectors.select("id")), ("crowded", crowded)]]
    groups = roots.groupBy("root").agg(F.count("*").alias("members"), F.min(F.struct(F.xxhash64("node"), "node"))["node"].alias("id"))
    drawn.append(("component", groups.orderBy(F.desc("members"), "root").limit(size).select("id")))
    tables = [rows.select("id", F.lit(name).alias("stratum")) for name, rows in drawn]
    return written(tables[0].unionAll(tables[1]).unionAll(tables[2]), "nn-sample")


def audit(vectors: DataFrame, links: DataFrame, roots: DataFrame, n: int, threshold: float,
          size: int = AUDIT) -> dict[tuple[str, str], float]:
    """Recall of ``links`` (id, n_links) by label and sample, each vector of a
    sample compared with all of its label; samples without a link have none."""
    drawn = _samples(vectors, links, roots, n, size)
    sample = vectors.join(F.broadcast(drawn.select("id").distinct()), "id").select("id", "label", "emb").toArrow()
    if sample.num_rows == 0:
        return {}
    by_label = {}
    names = np.asarray(sample["label"].to_pylist())
    emb = sample["emb"].combine_chunks()
    for label in sorted(set(names.tolist())):
        at = np.flatnonzero(names == label)
        by_label[label] = (np.asarray(sample["id"])[at], _matrix(emb.take(pa.array(at))))

    def run(batches):
        for b in batches:
            found = np.asarray(b.column(1).to_pylist(), dtype=object)
            for label, (ids, x) in by_label.items():
                at = np.flatnonzero(found == label)
                if len(at):
                    link = x @ _matrix(b.column(2).take(pa.array(at))).T >= threshold
                    link &= ids[:, None] != np.asarray(b.column(0))[at][None, :]
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(link @ np.asarray(b.column(3))[at])],
                                                     names=["id", "n"])

    truth = vectors.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = (truth.join(links, "id", "left").join(drawn, "id").join(vectors.select("id", "label"), "id")
            .groupBy("label", "stratum")
            .agg(F.sum("n").alias("n"), F.sum(F.least("n", F.coalesce("n_links", F.lit(0)))).alias("found"))
            .where("n > 0").collect())
    return {(r["label"], r["stratum"]): r["found"] / r["n"] for r in rows}


def near_duplicates(rows: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row (columns vec_id,
    embedding, label; others are not read).

    Vectors with a null label, that are null, zero or hold null or non-finite
    components have no link and are their own component.  Repeated rows of one
    vec_id are one vector.  A null vec_id has no link and a null component.
    """
    every = written(usable(rows).withColumns({
        "one": F.xxhash64("label", "emb"), "two": F.xxhash64(F.lit(1), "label", "emb")}), "nn-every")
    classes = written(_classes(every), "nn-classes")
    vectors = written(every.join(classes.select(F.col("rep").alias("id"), "copies"), "id")
                      .select("id", "label", "emb", "copies"), "nn-vectors")
    n = vectors.count()
    k, graph, more = NEIGHBOURS, None, None

    def counted(links):
        roots = written(components(links, "id", "other"), "nn-roots")
        return roots, written(_count_links(vectors, roots, threshold), "nn-links")

    seeds = count()      # of the tables of buckets; none is dealt twice
    for turn in range(TURNS):
        first = next(seeds) * TABLES
        fresh = _start(vectors, n, range(first, first + TABLES), k)
        graph = written(fresh if graph is None else _lists(fresh.unionAll(graph), k), "nn-graph")
        before = -1.0
        for step in range(ROUNDS):
            graph = written(_refined(vectors, graph, n, k, 1 + turn * ROUNDS + step), "nn-graph")
            now = graph.agg(F.coalesce(F.sum("cos"), F.lit(0.0))).first()[0]
            if now - before <= 0.001 * max(1, n):
                break
            before = now
        near = graph.where(F.col("cos") >= threshold).select("id", "other")
        more = _merged(vectors, near if more is None else near.unionAll(more), n, threshold, seeds)
        roots, links = counted(more)
        recall = audit(vectors, links, roots, n, threshold)
        _log.info("recall by label and sample after turn %d: %s", turn + 1, recall)
        short = sorted({label for (label, _), r in recall.items() if r < RECALL})
        if not short:
            break
        k *= 2
    else:
        _log.warning("recall under %s after %d turns: labels %s are compared exactly", RECALL, TURNS, short)
        roots, links = counted(_exact(vectors, more, short, threshold))
    named = roots.withColumnRenamed("node", "rep").join(links.withColumnRenamed("id", "rep"), "rep", "left")
    named = written(classes.join(named, "rep", "left").select(
        "one", "two", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "rep").alias("root")), "nn-named")
    found = written(every.select("id", "one", "two").join(named, ["one", "two"]).drop("one", "two"), "nn-found")
    return (rows.select("vec_id").join(found, F.col("vec_id") == F.col("id"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("root", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))


def op10_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
