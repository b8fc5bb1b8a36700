"""Prefix trie of conversations, with subtree figures by the Euler tour.

A node is a distinct sequence of the first d turns.  Sequences are told apart by
two 64-bit sums (xor) of hashes of (place, role, text), so the prefixes of a
conversation are a running window over narrow rows, also where one conversation
is very long.  A node is named by its smallest member and its depth.

Every node gets an enter and an exit arc; the arcs are linked into one tour
(children by name), and the list is ranked on Spark: tasks over ranges of names
first contract the chains that lie within them, what is left is ranked by
pointer doubling, and the chains are expanded again.  Ranking sums weights up
to the end of the tour, so each arc has its position and the leaves and savings
from there on; a subtree is the difference between its enter and exit arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.shared import written
from tributary.operators.ordered import ordered_scan

BLOCK_TURNS = 1024          # turns of a conversation in one window
CHUNK_IDS = 4096            # ids in one part of a node's list of ends
_WORD = r"[^\x20\x09-\x0D]+"
_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = ["depth", "h1", "h2"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, k1, k2, words): the turns of each conversation, numbered
    from 1 by turn (null first), role and a hash of the text; role and text are
    only kept as two hashes and a count of words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.xxhash64(role, text).alias("k1"), F.xxhash64(F.lit(17), text, role).alias("k2"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("nth"))
    return ordered_scan(rows, "conv_id", ["turn", "role", "k1", "nth"], F.lit(1), "nth", "pos", "later").select(
        "conv_id", F.col("pos").cast("long").alias("pos"), "k1", "k2", "words")


def rebuilt(turns: DataFrame, base: Column, kept: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations put together anew: the first ``kept`` turns (at most
    ``most``) of conversation ``base``, then the own turns after the first
    ``kept`` ones.  Returns (conv_id, n_turns), one row each, and the turns
    (conv_id, depth, k1, k2, words, is_last)."""
    heads = (turns.where(F.col("pos") <= most).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("pos", "k1", "k2", "words"))).alias("head"))
             .withColumnRenamed("conv_id", "base"))
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n_own")).withColumns({"kept": kept, "base": base})
    used = F.least("kept", F.coalesce(F.size("head"), F.lit(0)))
    convs = written(
        own.join(heads, "base", "left")
        .withColumn("head", F.slice("head", 1, F.greatest("kept", F.lit(0))))
        .withColumn("used", F.when(F.col("head").isNull(), 0).otherwise(used).cast("long"))
        .withColumn("n_turns", F.col("used") + F.greatest(F.col("n_own") - F.col("kept"), F.lit(0)))
        .select("conv_id", "kept", "used", "n_turns", "head"), "trie-conversations")
    first = convs.select("conv_id", "n_turns", F.inline("head")).withColumnRenamed("pos", "depth")
    rest = (turns.join(convs.drop("head"), "conv_id").where(F.col("pos") > F.col("kept"))
            .withColumn("depth", F.col("pos") - F.col("kept") + F.col("used")))
    columns = ["conv_id", "depth", "k1", "k2", "words", (F.col("depth") == F.col("n_turns")).alias("is_last")]
    return convs.select("conv_id", "n_turns"), first.select(*columns).unionAll(rest.select(*columns))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, h1, h2, p1, p2, words, is_last): the hashes of the first
    ``depth`` turns and of one turn fewer."""
    placed = turns.withColumns({
        "z1": F.xxhash64("k1", "k2", "depth"), "z2": F.xxhash64("k2", "depth", "k1"),
        "block": F.expr(f"(depth - 1) div {BLOCK_TURNS}")})
    up_to = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = placed.withColumns({"x1": F.bit_xor("z1").over(up_to), "x2": F.bit_xor("z2").over(up_to)})
    blocks = placed.groupBy("conv_id", "block").agg(F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select("conv_id", "block", F.bit_xor("z1").over(before).alias("c1"),
                          F.bit_xor("z2").over(before).alias("c2")).where("block > 0")
    h1, h2 = (F.col(f"x{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0).cast("long"))) for i in (1, 2))
    out = running.join(carry, ["conv_id", "block"], "left").withColumns({"h1": h1, "h2": h2})
    return out.select("conv_id", "depth", "h1", "h2", F.col("h1").bitwiseXOR(F.col("z1")).alias("p1"),
                      F.col("h2").bitwiseXOR(F.col("z2")).alias("p2"), "words", "is_last")


def nodes(convs: DataFrame, paths: DataFrame) -> DataFrame:
    """(depth, h1, h2, conv_id, n_convs, words, parent_conv_id), the root included."""
    zero = F.lit(0).cast("long")
    # one row, however many conversations
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("h1"), zero.alias("h2"), "conv_id", "n_convs", zero.alias("words"),
        zero.alias("p1"), zero.alias("p2"))
    found = paths.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    every = written(found.unionByName(root), "trie-found")
    above = every.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"),
                         F.col("conv_id").alias("parent_conv_id"))
    return written(every.join(above, ["depth", "p1", "p2"], "left").drop("p1", "p2"), "trie-nodes")


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, h1, h2, ends_sha256): the hash of the ids that end at a node,
    ascending and comma-joined.  Ids are joined in parts of at most CHUNK_IDS;
    a task reads a node's parts in order and keeps one hash state, no list."""
    parts = (ends.groupBy(*_NODE, F.floor(F.col("conv_id") / CHUNK_IDS).alias("chunk"))
             .agg(F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids")))
    kind = "depth long, h1 long, h2 long, ends_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for b in batches:
            done = []
            for *node, ids in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if node != last:
                    if last is not None:
                        done.append((*last, state.hexdigest()))
                    last, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _rows(done)
        if last is not None:
            yield _rows([(*last, state.hexdigest())])

    return (parts.repartition(*_NODE).sortWithinPartitions(*_NODE, "chunk").select(*_NODE, "ids")
            .mapInArrow(run, kind))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
        names=[*_NODE, "ends_sha256"])


# --- Euler tour ----------------------------------------------------------------

_ARC = ["c", "d", "k"]                       # node (smallest member, depth); 0 enter, 1 exit
_NEXT = ["nc", "nd", "nk"]
_HEAD = ["hc", "hd", "hk"]
_WEIGHTS = ["steps", "leaves", "saved"]


def tour_arcs(tree: DataFrame) -> DataFrame:
    """Enter and exit arcs of all nodes with the arc that follows; ``tree`` has
    conv_id, depth, parent_conv_id, n_convs, words, n_children, first_child and
    next_sibling (their conv_id)."""
    c, d, zero, one = F.col("conv_id"), F.col("depth"), F.lit(0).cast("long"), F.lit(1).cast("long")
    leaf = F.col("n_children") == 0

    def arc(kind, following, leaves, saved):
        return F.struct(c.alias("c"), d.alias("d"), F.lit(kind).cast("long").alias("k"),
                        *[v.alias(n) for v, n in zip(following, _NEXT, strict=True)],
                        one.alias("steps"), leaves.alias("leaves"), saved.alias("saved"))

    enter = arc(0, [F.when(leaf, c).otherwise(F.col("first_child")), F.when(leaf, d).otherwise(d + 1),
                    F.when(leaf, one).otherwise(zero)],
                leaf.cast("long"), (F.col("n_convs") - 1) * F.col("words"))
    more = F.col("next_sibling").isNotNull()
    root = d == 0
    leave = arc(1, [F.coalesce("next_sibling", "parent_conv_id"),
                    F.when(more, d).otherwise(F.when(root, None).otherwise(d - 1)),
                    F.when(more, zero).otherwise(F.when(root, None).otherwise(one))], zero, zero)
    return tree.select(F.inline(F.array(enter, leave)))


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The arcs of one range with the head of their chain within the range and
    the weights between; heads carry the whole chain and what follows it."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    t = pa.Table.from_batches(got)
    n = t.num_rows
    ids = list(zip(*(t[x].to_pylist() for x in _ARC), strict=True))
    after = list(zip(*(t[x].to_pylist() for x in _NEXT), strict=True))
    weights = np.stack([t[x].to_numpy() for x in _WEIGHTS], axis=1)
    place = {a: i for i, a in enumerate(ids)}
    follows = [place.get(a, -1) for a in after]
    is_head = np.ones(n, dtype=bool)
    is_head[[f for f in follows if f >= 0]] = False
    head = np.empty(n, dtype=np.int64)
    order = np.empty(n, dtype=np.int64)
    tail = {}
    k = 0
    for h in np.flatnonzero(is_head).tolist():
        i = h
        while i >= 0:
            head[i], order[k], last = h, i, i
            k += 1
            i = follows[i]
        tail[h] = last
    # sums along the chains: running sums in the order of the walk
    walked = weights[order]
    upto = np.cumsum(walked, axis=0)
    before = np.empty_like(upto)
    before[order] = upto - walked
    before -= before[head]
    whole = {h: before[e] + weights[e] for h, e in tail.items()}
    columns = [pa.array(x) for x in zip(*ids, strict=True)]
    columns += [pa.array(x) for x in zip(*(ids[h] for h in head.tolist()), strict=True)]
    columns += [pa.array(before[:, j]) for j in range(3)]
    columns += [pa.array([after[tail[i]][j] if i in tail else None for i in range(n)], pa.int64()) for j in range(3)]
    columns += [pa.array([int(whole[i][j]) if i in whole else None for i in range(n)], pa.int64()) for j in range(3)]
    out = pa.Table.from_arrays(columns, names=[*_ARC, *_HEAD, *(f"{w}_before" for w in _WEIGHTS), *_NEXT, *_WEIGHTS])
    yield from out.to_batches(max_chunksize=100_000)


_CONTRACTED = ", ".join(f"{x} long" for x in
                        [*_ARC, *_HEAD, *(f"{w}_before" for w in _WEIGHTS), *_NEXT, *_WEIGHTS])


def contracted(arcs: DataFrame) -> DataFrame:
    """All arcs with the chains that lie within a range of (c, d, k)."""
    ranged = arcs.repartitionByRange(*_ARC)
    return written(ranged.select(*_ARC, *_NEXT, *_WEIGHTS).mapInArrow(_contract, _CONTRACTED), "trie-chains")


def ranked(arcs: DataFrame) -> DataFrame:
    """(c, d, k, steps, leaves, saved): the weights from each arc, itself
    included, to the end of its list, by pointer doubling."""
    now = arcs.select(*_ARC, *_NEXT, *_WEIGHTS)
    there = [F.col(x).alias(f"t_{x}") for x in [*_ARC, *_NEXT, *_WEIGHTS]]
    turn = 0
    while not now.where("nc is not null").isEmpty():
        far = now.select(*there)
        met = (F.col("nc") == F.col("t_c")) & (F.col("nd") == F.col("t_d")) & (F.col("nk") == F.col("t_k"))
        now = written(
            now.join(far, met, "left").select(
                *_ARC, *[F.col(f"t_{x}").alias(x) for x in _NEXT],
                *[(F.col(w) + F.coalesce(f"t_{w}", F.lit(0).cast("long"))).alias(w) for w in _WEIGHTS]),
            f"trie-rank{turn}")
        turn += 1
    return now.select(*_ARC, *_WEIGHTS)


def expanded(chains: DataFrame, heads: DataFrame) -> DataFrame:
    """Weights to the end for every arc of ``chains`` from those of the heads."""
    known = heads.select(*[F.col(x).alias(h) for x, h in zip(_ARC, _HEAD, strict=True)],
                         *[F.col(w).alias(f"{w}_head") for w in _WEIGHTS])
    return chains.join(known, _HEAD).select(
        *_ARC, *[(F.col(f"{w}_head") - F.col(f"{w}_before")).alias(w) for w in _WEIGHTS])


def euler_tour(tree: DataFrame) -> DataFrame:
    """(c, d, k) of every arc with the weights from it to the end of the tour."""
    first = contracted(tour_arcs(tree))
    second = contracted(first.where("steps is not null"))
    ends = ranked(second.where("steps is not null"))
    return expanded(first, expanded(second, ends))


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations (``convs``: conv_id, n_turns;
    ``turns``: conv_id, depth, k1, k2, words, is_last): conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, and enter_at and exit_at, the places of its arcs
    in the tour (from 0).  No conversation, no node."""
    paths = written(prefixes(turns), "trie-prefixes")
    every = nodes(convs, paths)
    parent = F.struct(F.col("parent_conv_id"), F.col("depth"))
    below = every.where("depth > 0").withColumn("parent", parent)
    siblings = ordered_scan(below.select("parent", "depth", "conv_id"), "parent", ["conv_id"], F.lit(1), "conv_id",
                            "nth_child", "next_sibling").select("conv_id", "depth", "next_sibling")
    children = below.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"), F.min("conv_id").alias("first_child"))
    tree = written(
        every.join(siblings, ["conv_id", "depth"], "left").join(children, ["conv_id", "depth"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-tree")
    total = 2 * tree.count()
    sign = F.when(F.col("k") == 0, 1).otherwise(-1)
    subtree = euler_tour(tree).groupBy(F.col("c").alias("conv_id"), F.col("d").alias("depth")).agg(
        F.sum(sign * F.col("leaves")).alias("n_leaves"), F.sum(sign * F.col("saved")).alias("saved_tokens"),
        (F.lit(total) - F.max("steps")).alias("enter_at"), (F.lit(total) - F.min("steps")).alias("exit_at"))
    zero = F.lit(0).cast("long")
    ends = paths.where("is_last").select(*_NODE, "conv_id").unionAll(
        convs.where("n_turns = 0").select(zero, zero, zero, "conv_id"))
    return (tree.join(subtree, ["conv_id", "depth"]).join(ends_digests(ends), _NODE, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"), "enter_at", "exit_at"))


def conversation_trie(conversations: DataFrame, base: Column | None = None, kept: Column | None = None,
                      most: int = 0) -> DataFrame:
    """``prefix_trie`` of a table of turns (conv_id, turn, role, text; others
    are not read), optionally rebuilt: the first ``kept`` turns (at most
    ``most``) of conversation ``base`` replace the own first ones.

    Turns are ordered by turn (null first), then role, then a hash of the text;
    repeated rows are turns of their own.  Null role and text are empty.  Rows
    without a conv_id belong to no conversation and are left out.
    """
    turns = written(numbered_turns(conversations), "trie-turns")
    convs, whole = rebuilt(turns, base if base is not None else F.col("conv_id"),
                           kept if kept is not None else F.lit(0), most)
    return prefix_trie(convs, whole)


def op11_conversation_trie(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    conv = F.col("conv_id")
    nodes_of = conversation_trie(rows, conv - conv % 20,
                                 (F.crc32(conv.cast("string").cast("binary")) % 4).cast("int"), most=3)
    return nodes_of.drop("enter_at", "exit_at")


# crc32 of the digits, bit by bit
_CRC = """xor(4294967295::UBIGINT, list_reduce(
  list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
                        lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))))"""

OP11_SQL = rf"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
v AS (SELECT c, c - c % 20 AS base, ({_CRC} % 4)::BIGINT AS h, n FROM (SELECT c, count(*) AS n FROM t GROUP BY c)),
r AS (
  SELECT v.c, t.pos AS d, role, text FROM v JOIN t ON t.c = v.base AND t.pos <= v.h
  UNION ALL
  SELECT v.c, t.pos - v.h + least(v.h, coalesce(b.n, 0)) AS d, role, text
  FROM v JOIN t ON t.c = v.c AND t.pos > v.h LEFT JOIN v b ON b.c = v.base),
p AS (
  SELECT c, d, role, text,
         md5(string_agg(md5(role) || md5(text), ',') OVER (PARTITION BY c ORDER BY d)) AS node FROM r
  UNION ALL SELECT c, 0, '', '', '' FROM v),
q AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS parent, max(d) OVER (PARTITION BY c) AS m FROM p),
n AS (
  SELECT node, min(c) AS conv_id, any_value(d) AS depth, any_value(parent) AS parent, count(*) AS n_convs,
         (count(*) - 1) * max(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) AS saved,
         coalesce(string_agg(c, ',' ORDER BY c) FILTER (d = m), '') AS ends
  FROM q GROUP BY node),
k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
s AS (
  SELECT p.node, sum((n_children IS NULL)::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM n LEFT JOIN k USING (node) JOIN p ON p.c = n.conv_id AND p.d <= n.depth GROUP BY p.node)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, a.conv_id::BIGINT AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves, saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s USING (node) LEFT JOIN k USING (node) LEFT JOIN n a ON a.node = n.parent
"""
