"""Line dedup, similarity joins, mixing and the pipeline against brute force
and DuckDB."""

import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tributary.llm import components, embedding_dedup, jaccard_join, line_dedup, mixing, queries, toxicity
from tributary.plans.compare import compare, duck

from . import brute
from .conftest import DOC_SCHEMA, ODD, key, odd_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE[name])
    assert r["columns"] and r["values"] and r["spark_rows"] == r["oracle_rows"], r


# --- 7 line dedup

def test_line_dedup_equals_brute_force(spark, docs):
    rng = random.Random(1)
    rows = [(i, "\n".join(rng.choice(["a a", "b", "c c c", "d", "", " "]) for _ in range(rng.randint(0, 14))))
            for i in range(120)]
    out = line_dedup.line_dedup(docs(rows)).collect()
    assert sorted((r.doc_id, r.text, r.n_removed) for r in out) == sorted(brute.line_dedup(rows))


def test_line_dedup_odd_rows(spark, docs):
    table = docs(odd_rows()).withColumns({"n_lines": F.lit("x"), "window": F.lit(1), "starts": F.lit(2)})
    out = line_dedup.line_dedup(table)
    assert out.columns[:2] == ["doc_id", "text"] and {"window", "starts"} <= set(out.columns)
    got = {(r.doc_id, r.text) for r in out.collect()}
    assert (6, "a\nb\nc") in got and (7, "") in got and (0, None) in got and (None, "no id here at all") in got
    assert out.count() == len(odd_rows()) and line_dedup.line_dedup(docs([])).count() == 0


# --- 9 n-gram Jaccard join

def near_copies(rng, n_base=40, copies=6):
    rows, doc = [], 0
    for _ in range(n_base):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(3, 90))]
        for _ in range(rng.randint(1, copies)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(500)}"
            rows.append((doc, " ".join(words)))
            doc += 1
    return rows


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80), (1, 50)])
def test_join_equals_brute_force(spark, docs, k, percent):
    rows = near_copies(random.Random(k)) + [(9000 + i, t) for i, t in enumerate(ODD)]
    out = jaccard_join.jaccard_join(docs(rows), k, percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute.jaccard(rows, k, percent)


def test_join_of_one_large_group(spark, docs, monkeypatch):
    """More documents than a block holds, most of them linked only by chains."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "TASK_ROWS", 40)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"x{rng.randrange(60)}"
        rows.append((i, " ".join(words)))
    out = jaccard_join.jaccard_join(docs(rows), 4, 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == brute.jaccard(rows, 4, 85)


def test_join_odd_rows(spark, docs):
    table = docs(odd_rows() + [(None, "one")]).withColumns({"n": F.lit(1), "print": F.lit(2), "node": F.lit(3)})
    out = jaccard_join.jaccard_join(table).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=key)
    assert len(got) == len(odd_rows()) + 1
    assert (0, 0, 0) in got and (1, 0, 1) in got and (7, 1, 6) in got and got.count((6, 1, 6)) == 2
    assert all(c is None for d, _, c in got if d is None)
    assert jaccard_join.jaccard_join(docs([])).count() == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    got = {r.node: r.root for r in components.components(
        spark.createDataFrame(links + [(5, 5), (None, 3)], "a long, b long"), "a", "b").collect()}
    want = brute.roots({x for e in links for x in e}, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {i: want[i] for i in linked}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# --- 10 embeddings

def vectors(rng, clusters, size, dim=16):
    rows, i = [], 0
    for c in range(clusters):
        centre = rng.normal(size=dim)
        for _ in range(rng.integers(1, size)):
            v = centre + rng.normal(size=dim) * rng.choice([0.02, 0.05, 0.12])
            rows.append((i, [float(x) for x in v], int(c % 3)))
            i += 1
    return rows


def by_all_pairs(rows, threshold):
    x = np.array([v for _, v, _ in rows])
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    label = np.array([r[2] for r in rows])
    link = (x @ x.T >= threshold) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    root = brute.roots(range(len(rows)), [tuple(p) for p in np.argwhere(link)])
    return {i: (int(link[i].sum()), root[i]) for i in range(len(rows))}


def test_near_duplicate_vectors(spark):
    rows = vectors(np.random.default_rng(6), 60, 30)
    odd = [(5000, None, 1), (5001, [0.0] * 16, 1), (5002, [float("nan")] * 16, 1), (5003, rows[0][1], None),
           (5004, [float("inf")] * 16, 0), (5005, [1.0, 2.0], 0), (5006, [None] * 16, 0)]
    table = spark.createDataFrame(rows + odd + [rows[0], (None, rows[0][1], 0)],
                                  "vec_id long, embedding array<double>, label int")
    out = embedding_dedup.near_duplicates(table.withColumns({"id": F.lit(1), "root": F.lit(2)})).collect()
    assert len(out) == len(rows) + len(odd) + 2
    got = {r.vec_id: (r.n_links, r.component_id) for r in out}
    want = by_all_pairs(rows, 0.98)
    exact = sum(got[i][0] for i in want) / max(1, sum(n for n, _ in want.values()))
    assert exact >= 0.995 and sum(got[i] == want[i] for i in want) >= 0.99 * len(want)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert all(got[v] == (0, v) for v, _, _ in odd)
    assert [r.kept for r in out if r.vec_id is None] == [None]
    assert all(r.kept == (r.vec_id == r.component_id) for r in out if r.vec_id is not None)


def test_large_buckets_are_dealt_anew_in_each_table(spark):
    """600 members that share a bucket in all six tables meet across its groups."""
    rows = spark.range(600).crossJoin(spark.range(6).withColumnRenamed("id", "tbl"))
    groups = {}
    for r in embedding_dedup._dealt(rows, ["tbl"], 256, "id", "test-dealt").collect():
        groups.setdefault((r.tbl, r.sub), []).append(r.id)
    assert len(groups) == 18
    root = brute.roots(range(600), [(g[0], x) for g in groups.values() for x in g])
    assert set(root.values()) == {0}


def test_large_groups_of_equal_and_almost_equal_vectors(spark):
    """More of them than a bucket's group holds: still one component each."""
    rng = np.random.default_rng(9)
    same, near = rng.normal(size=16), rng.normal(size=16)
    rows = [(i, [float(x) for x in same], 0) for i in range(1100)]
    rows += [(1100 + i, [float(x) for x in near + rng.normal(size=16) * 1e-4], 0) for i in range(600)]
    rows += [(1700 + i, [float(x) for x in rng.normal(size=16)], 0) for i in range(200)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(table).collect()}
    assert got == by_all_pairs(rows, 0.98)


def tight_clusters(rng, dim=16):
    """Two clusters whose members are nearest to their own, at 0.985 to the other."""
    one, two = np.linalg.qr(rng.normal(size=(dim, 2)))[0].T
    two = 0.985 * one + np.sqrt(1 - 0.985 ** 2) * two
    return [(i, [float(x) for x in (one if i < 60 else two) + rng.normal(size=dim) * 1e-4], 0) for i in range(120)]


def test_full_lists_are_merged_across(spark):
    rows = tight_clusters(np.random.default_rng(3))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(table).collect()}
    assert got == by_all_pairs(rows, 0.98) and {c for _, c in got.values()} == {0}


def test_exact_comparison_when_recall_stays_short(spark, monkeypatch):
    """With nothing found by the graph, the audit sends the label to the blocks."""
    monkeypatch.setattr(embedding_dedup, "TURNS", 1)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 32)
    monkeypatch.setattr(embedding_dedup, "_merged", lambda vectors, links, *_: links.limit(0))
    rows = tight_clusters(np.random.default_rng(4))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(table).collect()}
    assert got == by_all_pairs(rows, 0.98)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(empty).count() == 0


# --- 4 mixing

def test_short_leaves_pass_on_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("a", "y", "s3", 50), ("b", "x", "s4", 1000)],
        "domain string, lang string, source string, tokens long")
    budget = spark.createDataFrame([(400,)], "budget long")
    out = {r.source: r.budget for r in mixing.leaf_budgets(leaves, budget, {}, 1).collect()}
    # a and b get 200 each; in a: x 100 and y 100, y holds 50, so x 150; in x: s1 holds 10
    assert out == {"s1": 10, "s2": 140, "s3": 50, "s4": 200}


def test_whole_subtree_short(spark):
    leaves = spark.createDataFrame([("a", "x", "s1", 10), ("a", "y", "s2", 20), ("b", "x", "s3", 1000)],
                                   "domain string, lang string, source string, tokens long")
    budget = spark.createDataFrame([(300,)], "budget long")
    plan = mixing.leaf_budgets(leaves, budget, {"domain": {"a": 9}}, 2)
    assert {r.source: (r.budget, r.whole, r.rest) for r in plan.collect()} == {
        "s1": (20, 2, 0), "s2": (40, 2, 0), "s3": (240, 0, 240)}


def test_mix_odd_rows_and_clashing_columns(spark):
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "src1", 1) for i, t in enumerate(ODD)]
    table = spark.createDataFrame(rows + [(None, "x y", None, None, None)], DOC_SCHEMA).withColumns(
        {"id": F.lit(1), "place": F.lit(2), "epoch": F.lit(3), "tokens": F.lit(4), "w": F.lit(5)})
    out = mixing.mix(table, budget_percent=100, max_epochs=1)
    assert set(table.columns) <= set(out.columns)
    got = out.collect()
    assert all(r.n_tokens > 0 and r.epoch == 1 for r in got)
    assert {r.doc_id for r in got} <= {3, 4, 5, 6, 7, None}
    assert mixing.mix(table.limit(0)).count() == 0


def test_mix_runs_natively(spark):
    plan = queries.QUERIES["op4_mixing"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- pipeline

def test_pipeline_equals_plain_python(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(table, spark.read.parquet(f"{SF}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(table, model).collect() if r.score >= 0.5}
    rows = {r.doc_id: r for r in table.collect() if r.doc_id not in toxic}
    solid = {i: sum(bool(brute.WORD.search(x)) for x in (r.text or "").split("\n")) for i, r in rows.items()}
    lines = {i: t for i, t, gone in brute.line_dedup([(i, r.text) for i, r in rows.items()])
             if gone == 0 or gone < solid[i]}
    kept = {i for i, _, root in brute.jaccard(list(lines.items()), 5, 80) if i == root}
    con = duckdb.connect()
    import pandas as pd
    frame = pd.DataFrame([(i, lines[i], rows[i].lang, rows[i].source) for i in sorted(kept)],
                         columns=["doc_id", "text", "lang", "source"])
    con.register("kept", frame)
    mixed = con.sql(mixing.op4_sql(corpus_pipeline.MIX_BUDGET_PERCENT, corpus_pipeline.MIX_EPOCHS,
                                   documents="kept")).df()
    lib = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(mixed.doc_id)
    for r in out:
        assert r.text == lines[r.doc_id] and r.n_chars == len(r.text)
        assert r.token_ids == lib.encode(r.text, add_special_tokens=False).ids


def test_stages_keep_the_columns_of_documents(spark):
    table = spark.createDataFrame(
        [(i, t, "en", "src1", len(t or "")) for i, t in enumerate(ODD)] + [(None, "x", None, None, None)],
        DOC_SCHEMA).withColumn("extra", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, SF)
        assert table.columns == corpus_pipeline.COLUMNS, name
        table.count()
    assert corpus_pipeline.STAGES[-1][1](spark, table.limit(0), SF).count() == 0


def test_one_of_each_tells_rows_apart(spark, tmp_path):
    """Two texts under one id, repeated rows, equal texts without an id."""
    base = " ".join(f"w{i}" for i in range(60))
    near = base.replace("w30 ", "x ")
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, base), (2, near), (2, other), (3, "alone " * 9), (3, "alone " * 9), (None, base), (None, "no id " * 9),
            (None, "no id " * 9), (7, None), (7, None), (8, " ")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC_SCHEMA).repartition(3).write.parquet(
        str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    out = dict(corpus_pipeline.STAGES)["jaccard_join"](spark, docs, SF).collect()
    want = [(1, base), (2, other), (3, "alone " * 9), (None, "no id " * 9), (7, None), (7, None), (8, " ")]
    assert sorted(((r.doc_id, r.text) for r in out), key=key) == sorted(want, key=key)
