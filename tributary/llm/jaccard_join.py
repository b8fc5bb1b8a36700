"""N-gram Jaccard self-join by prefixes under several global token orders.

Tokens are k-word shingles.  Under any global order two sets with
``|A & B| / |A | B| >= t`` share at least l tokens among their first
``floor((1 - t) * n) + l`` tokens.  A document stays a candidate only if this
can hold under *every* order:

1. order 1 (a hash order) over all documents: tokens of prefixes that no other
   set has in its prefix count for nothing; a document without enough shared
   prefix tokens has no partner and leaves;
2. order 2 (another hash order) over those that are left, again;
3. order 3, with a longer prefix: of its shared tokens each document also drops
   its l - 1 most frequent ones (the rarest common token is never among them),
   so that common phrases make no candidates.

Equal sets are one class from the start.  Each set that is left goes to the
leader that most of its kept tokens name, in blocks of about BLOCK sets; a block
and its leader are compared, exactly, set against set, so that a large group of
near copies is one component after linear work.  Only blocks that share a kept
token between different components, and whose sizes allow a link, are compared
further.  Each comparison returns a spanning forest of its links instead of all
pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm import shared
from tributary.llm.components import components
from tributary.llm.shared import written

BLOCK = 128
TASK_ROWS = 1000
_SEEDS = {2: np.uint64(0xA0761D6478BD642F), 3: np.uint64(0xE7037ED1A0B428DB)}
# extra prefix tokens (percent of the set) that must be shared, per order
EXTRA = {1: 5, 2: 5, 3: 30}


def _prefix_size(n: int, percent: int, extra: int) -> int:
    return min(n, (100 - percent) * n // 100 + 1 + extra * n // 100)


def _needed(n: Column, percent: int, extra: int) -> Column:
    """Shared prefix tokens that any partner implies: those of the smallest
    set that can still be one."""
    least = F.expr(f"({percent} * n + 99) div 100") if percent else F.lit(0)
    return F.lit(1) + F.floor(F.lit(extra) * least / F.lit(100)).cast("long")


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    for b in shared.small_batches(batches, 1):     # the text is the second column
        data, offsets = shared.text_buffer(b.column(1))
        sets: list[np.ndarray] = []
        for i, j in shared.doc_chunks(offsets):
            w = shared.Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], lower=True)
            ids = w.hashes()
            sets += [np.unique(shared.window_hashes(ids[w.range[d]:w.range[d + 1]], k))
                     for d in range(j - i)]
        yield b, sets


def _fingerprint(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _node(prints: list[bytes | None]) -> pa.Array:
    return pa.array([None if p is None else int.from_bytes(p[:8], "little", signed=True)
                     for p in prints], pa.int64())


def _under(order: int, s: np.ndarray, percent: int) -> np.ndarray:
    size = _prefix_size(len(s), percent, EXTRA[order])
    if order == 1:              # the sets are sorted by their own hash
        return s[:size]
    return s[np.argsort(shared.mix64(s ^ _SEEDS[order]))[:size]]


def first_pass(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, set size, fingerprint of the set, and its prefix in order 1."""
    def run(batches):
        for b, sets in _sets(batches, k):
            prints = [_fingerprint(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(prints, pa.binary()), _node(prints),
                 _lists([_under(1, s, percent) for s in sets])],
                names=["doc_id", "n", "print", "node", "prefix"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n long, print binary, node long, prefix array<long>")


def _second_pass(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Whole sets of the documents asked for (columns print, text)."""
    def run(batches):
        for b, sets in _sets(batches, k):
            prints = [_fingerprint(s) for s in sets]
            same = [p is not None and p == want.as_py() for p, want in zip(prints, b.column(0), strict=True)]
            keep = [i for i, s in enumerate(same) if s]
            sets, prints = [sets[i] for i in keep], [prints[i] for i in keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints, pa.binary()), _node(prints),
                 pa.array([len(s) for s in sets], pa.int64()), _lists(sets),
                 _lists([_under(2, s, percent) for s in sets]),
                 _lists([_under(3, s, percent) for s in sets])],
                names=["print", "node", "n", "tokens", "prefix2", "prefix3"])

    return docs.select("print", F.col("text").cast("string")).mapInArrow(
        run, "print binary, node long, n long, tokens array<long>, prefix2 array<long>, "
             "prefix3 array<long>")


def _survivors(sets: DataFrame, prefix: str, order: int, percent: int) -> DataFrame:
    """Nodes with enough prefix tokens that another set has in its prefix too.
    Rows of one node are copies of one set: they count once."""
    tokens = sets.select("node", F.explode(prefix).alias("token"))
    common = written(tokens.groupBy("token").agg(F.min("node").alias("a"), F.max("node").alias("b"))
                     .where("a < b").select("token"), f"jaccard-common{order}")
    shared_count = tokens.join(common, "token").groupBy("node").agg(F.count("*").alias("have"))
    size = sets.groupBy("node").agg(F.count("*").alias("copies"), F.max("n").alias("n"))
    return written(
        size.join(shared_count, "node")
        .where(F.col("have") >= F.col("copies") * _needed(F.col("n"), percent, EXTRA[order]))
        .select("node"), f"jaccard-left{order}")


def _kept(sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, tokens): the candidates of order 3 with the prefix tokens they
    keep."""
    tokens = sets.select("node", "n", F.explode("prefix3").alias("token"))
    common = written(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"),
                     "jaccard-common3")
    return written(
        tokens.join(common, "token").groupBy("node")
        .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "token")), False).alias("all"))
        .withColumn("need", _needed(F.col("n"), percent, EXTRA[3]))
        .where(F.size("all") >= F.col("need"))
        .withColumn("rest", F.expr("slice(all, cast(need as int), size(all))"))
        .select("node", "n", F.transform("rest", lambda t: t["token"]).alias("tokens")), "jaccard-kept")


def _blocks(kept: DataFrame) -> DataFrame:
    """(node, n, tokens, leader, block): the leader of a token is the smallest
    node that keeps it; a node goes to the leader that most of its tokens name,
    which among near copies is the same for all.  The nodes of a leader are
    dealt into blocks of about BLOCK."""
    tokens = kept.select("node", F.explode("tokens").alias("token"))
    leaders = tokens.groupBy("token").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where(
        "leader < last").select("token", "leader")
    chosen = written(tokens.join(leaders, "token").groupBy("node").agg(F.mode("leader", True).alias("leader")),
                     "jaccard-chosen")
    # where a leader follows another one, its nodes do too
    above = chosen.select(F.col("node").alias("leader"), F.col("leader").alias("above"))
    chosen = written(chosen.join(above, "leader", "left").select("node", F.coalesce("above", "leader").alias("leader")),
                     "jaccard-leaders")
    parts = written(chosen.groupBy("leader").agg(F.ceil(F.count("*") / BLOCK).alias("parts")), "jaccard-parts")
    placed = chosen.join(parts, "leader").select(
        "node", "leader", F.xxhash64("leader", F.expr("pmod(xxhash64(node, 7), parts)")).alias("block"))
    return written(kept.join(placed, "node"), "jaccard-blocks")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of a bounded group of sets."""
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    often = count[column] > 1
    row, column = row[often], column[often]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    if len(column) == 0:
        return out
    _, column = np.unique(column, return_inverse=True)
    width = max(1, 4_000_000 // len(sets))
    for begin in range(0, int(column.max()) + 1, width):
        some = (column >= begin) & (column < begin + width)
        part = np.zeros((len(sets), min(width, int(column.max()) + 1 - begin)), dtype=np.float32)
        part[row[some], column[some] - begin] = 1
        out += part @ part.T
    return out


def _forest(links: np.ndarray, n: int) -> list[tuple[int, int]]:
    """A spanning forest of the linked pairs (rows of two indices)."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in links.tolist():
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            out.append((a, b))
    return out


def _compare(table: pa.Table, percent: int) -> pa.Table:
    """All block comparisons of one task: links between sets of two blocks, or
    within one."""
    pair = np.stack([table["b1"].to_numpy(), table["b2"].to_numpy()], axis=1)
    block = table["block"].to_numpy()
    prints = table["print"].to_pylist()
    lists = table["tokens"].combine_chunks()
    values = np.asarray(lists.values)
    ends = np.asarray(lists.offsets)
    left, right = [], []
    order = np.lexsort((block, pair[:, 1], pair[:, 0]))
    cuts = np.flatnonzero((np.diff(pair[order], axis=0) != 0).any(axis=1)) + 1
    for rows in np.split(order, cuts):
        if len(rows) < 2:
            continue
        sets = [values[ends[r]:ends[r + 1]] for r in rows]
        size = np.array([len(s) for s in sets], dtype=np.int64)
        inter = _overlaps(sets).astype(np.int64)
        link = 100 * inter >= percent * (size[:, None] + size[None, :] - inter)
        link = np.triu(link, 1)
        if pair[rows[0], 0] != pair[rows[0], 1]:
            link &= block[rows][:, None] != block[rows][None, :]
        for a, b in _forest(np.argwhere(link), len(rows)):
            left.append(prints[rows[a]])
            right.append(prints[rows[b]])
    return pa.table({"a": pa.array(left, pa.binary()), "b": pa.array(right, pa.binary())})


def _compared(rows: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """Links (a, b: prints) among the rows (b1, b2, block, node) of each pair of
    blocks, or of one block where b1 = b2."""
    rows = written(rows, f"jaccard-{name}-rows")
    tasks = 1 + rows.count() // TASK_ROWS
    dealt = rows.hint("merge").join(sets.select("node", "print", "tokens"), "node").drop("node").withColumn(
        "task", F.expr(f"pmod(xxhash64(b1, b2), {tasks})"))
    return written(dealt.groupBy("task").applyInArrow(lambda t: _compare(t, percent), "a binary, b binary"),
                   f"jaccard-{name}-links")


def _inside(blocks: DataFrame) -> DataFrame:
    """Every block with its leader."""
    rows = blocks.select("block", "node").unionAll(blocks.select("block", F.col("leader").alias("node"))).distinct()
    return rows.select(F.col("block").alias("b1"), F.col("block").alias("b2"), "block", "node")


def _between(sets: DataFrame, blocks: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """What the links inside blocks leave open: pairs of blocks that share a
    token some of whose nodes lie in different components, with nodes in
    different components and of sizes that can be linked.  Only nodes that hold
    such a token take part."""
    roots = written(components(links, "a", "b"), "jaccard-inside")
    named = sets.select("node", "print").join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "node", F.coalesce("root", "print").alias("part"))
    tokens = written(blocks.select("node", "n", "block", F.explode("tokens").alias("token"))
                     .join(written(named, "jaccard-part-of"), "node"), "jaccard-tokens")
    per = tokens.groupBy("token", "block").agg(
        F.min("part").alias("p"), F.max("part").alias("q"), F.min("n").alias("least"), F.max("n").alias("most"))
    open_ = written(per.groupBy("token").agg(F.min("p").alias("p"), F.max("q").alias("q"))
                    .where("p != q").select("token"), "jaccard-open")
    per = written(per.join(open_, "token"), "jaccard-block-tokens")
    one, two = (per.select("token", *[F.col(c).alias(f"{c}{i}") for c in ("block", "p", "q", "least", "most")])
                for i in (1, 2))
    pairs = written(
        one.join(two, "token")
        .where("block1 < block2 and not (p1 = q1 and p2 = q2 and p1 = p2)")
        .where(f"100 * most1 >= {percent} * least2 and 100 * most2 >= {percent} * least1")
        .select(F.col("block1").alias("b1"), F.col("block2").alias("b2")).distinct(), "jaccard-block-pairs")
    sides = pairs.select("b1", "b2", F.col("b1").alias("block")).unionAll(
        pairs.select("b1", "b2", F.col("b2").alias("block")))
    members = tokens.join(open_, "token", "left_semi").select("block", "node").distinct()
    return sides.join(members, "block").select("b1", "b2", "block", "node")


def _links(sets: DataFrame, left: DataFrame, percent: int) -> DataFrame:
    """Links (a, b: prints) among the sets whose nodes are in ``left``."""
    blocks = _blocks(_kept(sets.select("node", "n", "prefix3").join(left.hint("merge"), "node"), percent))
    inside = _compared(_inside(blocks), sets, percent, "inside")
    between = _compared(_between(sets, blocks, inside, percent), sets, percent, "between")
    return inside.unionAll(between)


def jaccard_join(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links)
    of every row of ``docs`` (columns doc_id and text; others are not read).

    Words are split at ASCII white space and compared with A-Z lower-cased.  A
    text of fewer than ``k`` words is one shingle; null, empty and blank texts
    have none and link with nothing.  Rows with a null doc_id link with nothing
    and have a null component_id.  Repeated rows are copies: each gets its own
    row of the result.
    """
    first = written(first_pass(docs, k, percent), "jaccard-first")
    some = first.where("node is not null and doc_id is not null")
    left = _survivors(some, "prefix", 1, percent)
    # one document per set, found again by its id, gives the whole set
    one = (some.select("doc_id", "node", "print").join(left, "node")
           .groupBy("print").agg(F.min("doc_id").alias("doc_id")))
    # what is joined to whole texts and sets grows with the corpus: the plan is
    # the same merge join at every size
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(one.hint("merge"), "doc_id")
    sets = _second_pass(texts.select("print", "text"), k, percent)
    sets = written(sets.dropDuplicates(["print"]), "jaccard-sets")
    left = _survivors(sets, "prefix2", 2, percent)
    links = _links(sets, left, percent)
    roots = written(components(links, "a", "b"), "jaccard-roots")
    classes = (some.groupBy("print").agg(F.min("doc_id").alias("id"))
               .join(roots.withColumnRenamed("node", "print"), "print", "left")
               .withColumn("root", F.coalesce("root", "print")))
    classes = written(classes, "jaccard-classes")
    named = written(classes.groupBy("root").agg(F.min("id").alias("component_id")), "jaccard-named")
    component = written(classes.join(named, "root").select("print", "component_id"), "jaccard-components")
    return (first.select("doc_id", F.col("n").alias("n_shingles"), "print").join(component, "print", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("print").isNull() | F.col("doc_id").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id")))


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4, percent=85)
