"""Conversation trie, periodic runs and token files against brute force."""

import glob
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tributary.llm import conversation_trie, periodic_runs, queries, token_files
from tributary.session import scratch_path

from .conftest import ODD, WORD, key, odd_rows

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# --- 11 conversation prefix trie

def brute_trie(convs):
    """Nodes of {conv_id: [(role, text), ...]} by plain dictionaries."""
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    leaves, saved, out = {}, {}, set()
    for p in sorted(members, key=len, reverse=True):
        m = members[p]
        leaves[p] = sum(leaves[q] for q in kids[p]) or 1
        saved[p] = (len(m) - 1) * (len(WORD.findall(p[-1][1])) if p else 0) + sum(saved[q] for q in kids[p])
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def brute_rebuilt(rows):
    own = defaultdict(list)
    for r in rows:
        own[r.conv_id].append(((r.turn is not None, r.turn or 0), r.role or "", r.text or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    kept = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - c % 20, [])[:kept[c]] + own[c][kept[c]:] for c in own}


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_trie_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    assert as_set(queries.QUERIES["op11_conversation_trie"](spark, SF)) == brute_trie(brute_rebuilt(rows))


TURNS = "conv_id long, turn long, role string, text string"


def random_turns(rng, n):
    rows = []
    for c in range(n):
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c * rng.choice([1, 1, 977]), t if t else None, rng.choice(["u", "a"]),
                         rng.choice(["x", "y y", "z  z z"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_of_random_conversations(spark, docs, seed):
    rows = sorted(set(random_turns(random.Random(seed), 150)), key=key)
    convs = defaultdict(dict)
    for c, t, role, text in rows:            # one row per turn, or order among them is by hash
        convs[c].setdefault(t, (role, text))
    table = [(c, t, *x) for c, v in convs.items() for t, x in v.items()]
    plain = {c: [v[t] for t in sorted(v, key=lambda t: (t is not None, t or 0))] for c, v in convs.items()}
    out = conversation_trie.conversation_trie(docs(table, TURNS))
    assert as_set(out.drop("enter_at", "exit_at")) == brute_trie(plain)


def test_trie_places_are_a_tour(spark, docs):
    rows = [(c, t, "u", "ab"[(c >> t) & 1]) for c in range(40) for t in range(4)]
    out = conversation_trie.conversation_trie(docs(rows, TURNS)).collect()
    assert sorted([r.enter_at for r in out] + [r.exit_at for r in out]) == list(range(2 * len(out)))
    at = {(r.conv_id, r.depth): r for r in out}
    for r in out:
        assert r.enter_at < r.exit_at
        if r.depth:
            up = at[(r.parent_conv_id, r.depth - 1)]
            assert up.enter_at < r.enter_at and r.exit_at < up.exit_at


def test_trie_of_one_long_conversation_and_many_alike(spark, docs, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BLOCK_TURNS", 16)
    monkeypatch.setattr(conversation_trie, "CHUNK_IDS", 8)
    rows = [(5, t, "u", str(t)) for t in range(700)]
    rows += [(c, t, "u", str(t)) for c in range(100, 160) for t in range(3)]
    rows += [(c, 0, "a", "only") for c in range(200, 230)]
    plain = defaultdict(list)
    for c, _, role, text in rows:
        plain[c].append((role, text))
    out = conversation_trie.conversation_trie(docs(rows, TURNS)).drop("enter_at", "exit_at")
    assert as_set(out) == brute_trie(plain)


def test_trie_odd_rows(spark, docs):
    rows = [(1, None, None, None), (1, 0, "u", ""), (1, 0, "u", ""), (2, None, "", ""), (None, 1, "u", "x"),
            (-7, 0, "u", "long " * 5000), (40, 1, "u", "a"), (41, 0, "u", "a")]
    table = docs(rows, TURNS).withColumns({"depth": F.lit("x"), "h1": F.lit(1), "kept": F.lit(2), "c": F.lit(0)})
    plain = {1: [("", ""), ("u", ""), ("u", "")], 2: [("", "")], -7: [("u", "long " * 5000)],
             40: [("u", "a")], 41: [("u", "a")]}
    out = conversation_trie.conversation_trie(table).drop("enter_at", "exit_at")
    assert as_set(out) == brute_trie(plain)
    assert conversation_trie.conversation_trie(docs([], TURNS)).count() == 0


def test_trie_with_turnless_conversations(spark, docs, tmp_path):
    rows = [(c, t, "u", f"{c % 3} {t}") for c in [*range(60, 80), *range(101, 120), 7] for t in range(c % 4 + 1)]
    table = docs(rows, TURNS)
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    want = brute_rebuilt(table.collect())
    assert any(not turns for turns in want.values())
    assert as_set(queries.QUERIES["op11_conversation_trie"](spark, str(tmp_path))) == brute_trie(want)


# --- 12 periodic runs

def brute_runs(words, least=12):
    found, n = set(), len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            size, part = i - s + q, words[s:i + q]
            if i > s and size >= max(least, 2 * q) and not any(part[:-r] == part[r:] for r in range(1, q)):
                found.add((s, size, q))
            i = max(i, s + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    x = [rng.randrange(rng.choice([1, 2, 2, 3, 5, 9])) for _ in range(rng.randint(0, 45))]
    if x and rng.random() < 0.5:
        p = rng.randint(1, 9)
        x = x[:rng.randint(0, 6)] + (x[:p] * 30)[:len(x)] + x[:rng.randint(0, 5)]
    return x


def test_lyndon_array_and_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        x = random_words(rng)
        longest = [next((j for j in range(i + 1, len(x)) if x[j:] < x[i:]), len(x)) - i for i in range(len(x))]
        assert periodic_runs.lyndon_array(x).tolist() == longest
        for least in (2, 12):
            got = periodic_runs.runs_of(np.array(x, dtype=np.int64), least)
            assert [tuple(r) for r in got.tolist()] == brute_runs(x, least)


def test_runs_of_words_with_many_squares():
    thue = [bin(i).count("1") % 2 for i in range(2048)]         # collides under sums modulo 2**64
    fib, more = [0], [0, 1]
    while len(more) < 700:
        fib, more = more, more + fib
    for x in (thue, more, [0] * 500, list(range(7)) * 60):
        got = periodic_runs.runs_of(np.array(x, dtype=np.int64))
        assert [tuple(r) for r in got.tolist()] == brute_runs(x)


def test_wrong_extensions_are_measured_again(monkeypatch):
    x = np.array([*range(12)] * 3 + [5] * 20 + [*range(30)], dtype=np.int64)
    want = brute_runs(x.tolist())
    after = periodic_runs._Common.after
    monkeypatch.setattr(periodic_runs._Common, "after",
                        lambda self, i, j: np.minimum(after(self, i, j) + 3, self.n - j))
    assert [tuple(r) for r in periodic_runs.runs_of(x).tolist()] == want


def test_runs_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = set()
    for r in rows:
        w = WORD.findall(r.text or "")
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        number = {}
        runs = brute_runs([number.setdefault(x, len(number)) for x in w]) if len(w) < 3000 else None
        if runs is None:                 # too long for brute force: by the tested core
            at = np.array([number.setdefault(x, len(number)) for x in w], dtype=np.int64)
            runs = [tuple(x) for x in periodic_runs.runs_of(at).tolist()]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
        want.add((r.doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                  hashlib.sha256(lines.encode()).hexdigest(),
                  hashlib.sha256(brute_collapsed(w, runs).encode()).hexdigest()))
    got = as_set(queries.QUERIES["op12_periodic_runs"](spark, SF))
    assert got == want and sum(r[1] > 0 for r in got) > 10


def test_runs_of_texts_in_one_batch(spark, docs):
    rng = random.Random(8)
    rows = [(i, rng.choice([" ", "\n", " \t"]).join("abcdefghi"[v] for v in random_words(rng))) for i in range(300)]
    for r in periodic_runs.periodic_runs(docs(rows)).collect():
        words = WORD.findall(r.text)
        runs = brute_runs(words)
        assert [tuple(x) for x in r.runs] == runs and r.collapsed == brute_collapsed(words, runs)


def test_runs_odd_rows(spark, docs):
    table = docs(odd_rows()).withColumns({"runs": F.lit("x"), "start": F.lit(1), "best": F.lit(2)})
    out = periodic_runs.periodic_runs(table)
    assert out.columns == ["doc_id", "text", "start", "best", "runs", "collapsed"]
    got = out.collect()
    assert len(got) == len(odd_rows())
    for r in got:
        if r.text == ODD[4]:
            assert [tuple(x) for x in r.runs] == [(0, 4000, 1)] and r.collapsed == "word"
        else:
            assert r.runs == [] and r.collapsed == " ".join(WORD.findall(r.text or ""))
    assert periodic_runs.periodic_runs(docs([])).count() == 0


# --- 13 token files

def library_ids(texts, end=(1,)):
    t = Tokenizer.from_file(TOKENIZER)
    return [[*e.ids, *end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_token_query_equals_the_library(spark):
    rows = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    want, start = set(), 0
    for r, ids in zip(rows, library_ids([r.text for r in rows]), strict=True):
        want.add((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert as_set(queries.QUERIES["op13_token_files"](spark, SF)) == want


TRICKY = ["<|endoftext|> a", "A\x1cB \x1f c", "tab\tnew\nline nbsp em\x85nel", "İstanbul ΑΣ ς", "é é 각",
          "don't we'll 123 ...!?", "<|startoftext|>x<|endoftext|>", "​ zero​width", "𝔘nicode 👍🏽"]


def written_files(spark, table, **kw):
    folder = scratch_path(spark, "test-token-files")
    token_files.write_token_files(table, folder, TOKENIZER, **kw)
    return folder


def test_token_files_odd_rows(spark, docs):
    texts = [*TRICKY, *[t for _, t in odd_rows()]]
    rows = list(enumerate(texts)) + [(None, "no id"), (None, None), (3, "another text of this id"), (3, TRICKY[3])]
    table = docs(rows).withColumns({"part": F.lit("x"), "ids": F.lit(1), "base": F.lit(2), "same": F.lit(3)})
    folder = written_files(spark, table.repartition(5))
    got = sorted(((r.doc_id is not None, r.doc_id or 0), r.ids)
                 for r in token_files.read_documents(spark, folder).collect())
    want = sorted(((i is not None, i or 0), ids)
                  for (i, _), ids in zip(rows, library_ids([t for _, t in rows]), strict=True))
    assert got == want
    lengths = token_files.read_lengths(spark, folder).orderBy("start").collect()
    assert [r.start for r in lengths] == np.cumsum([0, *[r.n_tokens for r in lengths]])[:-1].tolist()
    order = [(r.doc_id is not None, r.doc_id or 0) for r in lengths]
    assert order == sorted(order)
    empty = written_files(spark, docs([]))
    assert token_files.read_digests(spark, empty).count() == 0
    assert token_files.read_token_range(spark, empty, 0, 10).count() == 0


def test_token_ranges_and_selective_reads(spark, docs):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "δ"]) for _ in range(rng.randint(0, 30))))
            for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = written_files(spark, table, page_rows=50)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stream = [i for ids in library_ids([t for _, t in rows]) for i in ids]
    for a, b in [(0, 10), (5000, 5007), (123, 20000), (len(stream) - 3, len(stream) + 50), (7, 7)]:
        out = token_files.read_token_range(spark, folder, a, b).orderBy("start").collect()
        assert [i for r in out for i in r.ids] == stream[a:b]
        assert not out or out[0].start == a

    few = token_files.read_documents(spark, folder, F.col("doc_id").isin(17, 1500))
    assert {r.doc_id: r.ids for r in few.collect()} == {
        i: ids for i, ids in zip((17, 1500), library_ids([rows[17][1], rows[1500][1]]), strict=True)}
    plan = few._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    assert scan.metrics().apply("numOutputRows").value() <= 200       # pages, not files
    assert "ids" not in token_files.read_lengths(spark, folder)._jdf.queryExecution().executedPlan().toString()


def test_token_file_format(spark, docs):
    rows = [(i, f"word{i % 7} again and again") for i in range(2000)]
    folder = written_files(spark, docs(rows), page_rows=100, row_group_bytes=1 << 12)
    files = glob.glob(f"{folder.removeprefix('file:')}/tokens/*.parquet")
    groups = 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                assert column.has_offset_index and column.has_column_index
                if column.path_in_schema in ("doc_id", "before", "after", "n_tokens"):
                    assert column.encodings == ("DELTA_BINARY_PACKED",)
                elif column.path_in_schema.startswith("ids"):
                    assert "RLE_DICTIONARY" in column.encodings
    assert groups > len(files)
