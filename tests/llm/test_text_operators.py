"""Rules, extraction, classifiers, counts and BPE against brute force, the
tokenizers library, or held-out labels."""

import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tributary.llm import bpe, html_extraction, quality_classifier, quality_rules, token_counts, toxicity

from .brute import base_measures
from .conftest import ODD, key, odd_rows

SF = "/root/testdata/sf0.001"
WORDS = [f"{a}{b}" for a in ("ban", "tor", "mel", "sun", "gri", "pol") for b in ("der", "ing", "a", "ost", "ith")]


def prose(rng, n):
    out = [rng.choice(WORDS) + (rng.choice([".", ","]) if rng.random() < 0.15 else "") for _ in range(n)]
    return " ".join(out)


# --- 1 quality rules

def test_measures_equal_brute_force(spark, docs):
    rng = random.Random(3)
    line = prose(rng, 9)
    texts = ODD + [prose(rng, 60), line + "\n" + line + "\n\n" + line, "x y " * 30, "#*$ a|b <c> & 100%"]
    out = quality_rules.measures(docs(list(enumerate(texts)))).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out}
    assert got == {i: base_measures(t) for i, t in enumerate(texts)}


def test_rules_keep_prose_and_reject_junk(spark, docs):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        words = [f"{rng.choice(WORDS)}{rng.choice(WORDS)}" for _ in range(80)]
        if i % 8 == 0:
            words = [w + rng.choice(["***", "$$$", "%%%"]) for w in words]
        elif i % 8 == 1:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words) + "."))
    out = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs(rows)).collect()}
    assert all(out[i] == (i % 8 > 1) for i in out)


def test_rules_on_odd_rows_and_empty_table(spark, docs):
    clash = docs(odd_rows()).withColumns({"n_words": F.lit("x"), "kept": F.lit(7)})
    out = quality_rules.quality_rules(clash).collect()
    assert len(out) == len(odd_rows())
    assert all(r.base_failed and not r.kept for r in out if r.n_words < 20)
    assert quality_rules.quality_rules(docs([])).count() == 0


def test_em_orders_rules_by_accuracy():
    rng = np.random.default_rng(1)
    good = rng.random(5000) < 0.8
    votes = np.stack([np.where(rng.random(5000) < acc, good, ~good) * 2 - 1 for acc in (0.99, 0.95, 0.8)], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_rules.fit(patterns, counts.astype(float))
    assert model["right_good"][0] > model["right_good"][2]
    assert quality_rules.fit(np.zeros((0, 3)), np.zeros(0))["share_good"] == pytest.approx(0.85)


# --- 2 extraction

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{a:b}</style><script>var s="</p>";</script></head>
<body class="no-sidebar"><header><h2>Site</h2></header><nav><ul><li><a href="/a">Menu one</a></li></ul></nav>
<div id="cookieNotice">We use cookies, many of them, and say so at length.</div>
<article class="post"><h1>Head&amp;line &lt;1&gt;</h1><p>First   par&eacute;graph,
<b>bold</b>text.<p>Second<br>line &#8212; dash.</p><div class="share"><a href="#">Share</a></div>
<form><input value="x"><button>Send</button></form><ul><li>One item.<li>Two item.</ul></article>
<aside>Other stories, which are long enough to look like text.</aside><div class="ad">Buy now, buy well.</div>
<section class="comments"><p>A reader says something long, with commas, and points.</p></section>
<footer>&copy; Someone</footer></body></html>"""


def test_article_without_the_rest():
    assert html_extraction.extract(PAGE) == (
        "Head&line <1>\nFirst parégraph, boldtext.\nSecond\nline — dash.\nOne item.\nTwo item.")


def test_page_without_article_element():
    page = ("<html><body><div class='menu'><a href=x>Home</a> <a href=y>More</a></div><div id=content>"
            "<p>Some long text here, with commas, and a point.</p><p>Ti.</p><p>More long text, as before it "
            "was.</p></div><div class='footer'>Imprint</div></body></html>")
    assert html_extraction.extract(page).split("\n") == [
        "Some long text here, with commas, and a point.", "Ti.", "More long text, as before it was."]


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "</div></div>", "<script>x", "<!-- never closed",
                                  "<a href=\"unclosed>text", "&am", "<nav>only menu</nav>", "<div>" * 300])
def test_odd_pages_do_not_fail(page):
    assert isinstance(html_extraction.extract(page), str)


LONG = "Some sentence, with words. And another one, longer than that, follows here."


@pytest.mark.parametrize("page,want", [
    (f"<form><article><h1>T</h1><p>{LONG}</p></article></form>", ["T", LONG]),
    (f"<nav><a href=x>Home</a><article><h1>T</h1><p>{LONG}</p></article>", ["T", LONG]),
    (f"<form><div><h1>T</h1><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><input></form>", ["T"] + [LONG] * 3),
    (f"<main><h1>T</h1><p>{LONG}</p><div itemprop=articleBody><p>{LONG * 3}</p><p>{LONG * 5}</p></div></main>",
     ["T", LONG, LONG * 3, LONG * 5]),
    (f"<article><p>{LONG}</p></article><div>x</div><article><p>{LONG}</p></article>", [LONG, LONG]),
    ("<nav><a>x</a></nav><form><p>Name<p>Street</form><footer>all</footer>", [""])])
def test_wrapped_and_split_articles(page, want):
    assert html_extraction.extract(page).split("\n") == want


def test_paths_choose_the_article_without_marks():
    """Given pages, with their marks renamed: the paths alone find the article."""
    path = "/root/testdata/sf0.01/pages.parquet"
    pages = pq.read_table(path, columns=["html"]).column(0).to_pylist()
    renamed = [re.sub(r"(</?)(article|main)\b", r"\1div", p or "") for p in pages]
    assert pages != renamed
    assert [html_extraction.extract(p) for p in pages] == [html_extraction.extract(p) for p in renamed]


def test_ratios_separate_text_from_nameless_blocks():
    junk = "<div><div>Home</div><div>News</div><div>Buy now</div></div>"
    page = f"<body>{junk}<div><h1>T</h1>" + f"<p>{LONG * 4}</p>" * 6 + f"<p>Ti.</p></div>{junk}</body>"
    assert html_extraction.extract(page).split("\n") == ["T"] + [LONG * 4] * 6 + ["Ti."]


@pytest.mark.parametrize("part,n", [("<div>x", 20000), ("<b>x", 20000), ("<h1>x", 20000), ("<ul><li>x", 10000),
                                    ("<p>x<b>", 20000), ("<i><div>x</b>", 10000)])
def test_deep_pages_take_linear_memory(part, n):
    tracemalloc.start()
    got = html_extraction.extract(part * n)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.count("x") == n
    assert peak < 4000 * n


def test_extraction_keeps_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (3, "v", "")]
    out = html_extraction.html_extraction(
        spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)))
    got = sorted(((r.page_id, r.url, r.n_chars) for r in out.collect()), key=key)
    n = len(html_extraction.extract(PAGE))
    assert got == sorted([(1, "u", n), (1, "u", n), (None, None, 0), (3, "v", 0)], key=key)


# --- 3 toxicity

def labelled(rng, n, toxic_of):
    return [(i, prose(rng, 40) + (" you " + rng.choice(["vilefool", "grimlout"]) + "." if toxic_of(i) else "."))
            for i in range(n)]


def test_toxic_words_are_learned_held_out(spark, docs):
    rng = random.Random(2)
    toxic_of = lambda i: i % 7 == 0
    table = docs(labelled(rng, 600, toxic_of) + [(None, None), (10_000, ""), (10_000, "")])
    labels = spark.createDataFrame([(i, int(toxic_of(i))) for i in range(600)] + [(601, None), (None, 1)],
                                   "doc_id long, toxic int")
    model = toxicity.train(table, labels)
    out = toxicity.score(table, model).collect()
    assert len(out) == 603 and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = sum((r.score >= 0.5) == toxic_of(r.doc_id) for r in held)
    assert len(held) > 80 and right >= 0.98 * len(held)
    assert toxicity.keep_clean(table, model).count() == 603 - sum(r.score >= 0.5 for r in out)


def test_no_labels_and_empty_table(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs(odd_rows()), none)
    assert toxicity.score(docs(odd_rows()), model).count() == len(odd_rows())
    assert toxicity.score(docs([]), model).count() == 0


def test_swaps_close_the_gap_between_groups():
    assert toxicity.swaps("Women and men") == ["men and women"] and toxicity.swaps("nobody") == []
    assert toxicity.swaps("Été of the Gay man, ÉTÉ") == [
        "Été of the straight woman, ÉTÉ", "Été of the lesbian man, ÉTÉ", "Été of the bisexual woman, ÉTÉ"]
    x = np.zeros((400, 3))
    y = np.zeros(400)
    x[:200, 0] = 1                       # column 0: group A, which the labels treat unfairly
    x[200:, 1] = 1                       # column 1: group B
    x[::4, 2] = 1                        # column 2: the insult
    y[::4] = 1
    y[1:200:3] = 1
    changed = np.zeros((400, 3))
    changed[:200] = [1, -1, 0]
    changed[200:] = [-1, 1, 0]
    plain, _ = toxicity.fit(x, y, np.zeros((3, 3)))
    fair, _ = toxicity.fit(x, y, changed.T @ changed)
    assert plain[0] - plain[1] > 1 > 0.3 > abs(fair[0] - fair[1])


def test_changes_are_the_sum_over_rows():
    terms = ["women", "men", "blackness", "idiot"]
    selected = np.unique(np.concatenate(toxicity._features_of(pa.array(terms))))
    rows = [{"own": toxicity._known(selected, toxicity._features_of(pa.array([t]))[0]).tolist(),
             "swapped": [toxicity._known(selected, toxicity._features_of(pa.array([c]))[0]).tolist()
                         for c in toxicity.swaps(t)]} for t in ("the women", "an idiot", "")]
    got, n = toxicity.changes(rows, selected)

    def vector(at):
        v = np.zeros(len(selected))
        v[np.asarray(at, dtype=int)] = 1
        return v

    want = [vector(rows[0]["own"]) - vector(c) for c in rows[0]["swapped"]]
    for r in rows[1:]:
        for a, b in toxicity.mentions(selected):
            named, other = np.maximum(vector(r["own"]), vector(a)), np.maximum(vector(r["own"]), vector(b))
            want += [vector(r["own"]) - named, named - other]
    want = [w for w in want if w.any()]
    assert n == len(want) > 5
    assert np.allclose(got, sum(np.outer(w, w) for w in want))


def test_neutral_mentions_do_not_raise_scores(spark, docs):
    """Labels give 'blackguard' to the toxic: 'black' shares its beginning."""
    rng = random.Random(2)

    def text(i):
        words = [rng.choice(WORDS) for _ in range(30)]
        return " ".join([*words, "blackguard"] if i % 4 == 0 else words)

    table = docs([(i, text(i)) for i in range(800)])
    model = toxicity.train(table, spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(800)],
                                                        "doc_id long, toxic int"))
    probe = docs([(0, "one black two"), (1, "one white two"), (2, "one blackguard two")])
    got = {r.doc_id: r.score for r in toxicity.score(probe, model).collect()}
    assert got[2] > 0.5 > got[0] and abs(got[0] - got[1]) < 0.1


def test_repeated_ids_train_once(spark, docs):
    rows = [(i, f"word{i % 7} idiot" if i % 2 else f"word{i % 7} fine") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    once, often = (toxicity.train(docs(t), labels) for t in (rows, rows * 5))
    assert np.array_equal(once["selected"], often["selected"])
    assert np.allclose(once["w"], often["w"], atol=1e-3)


# --- 5 quality classifier

def test_positive_unlabelled_held_out(spark, docs):
    rng = random.Random(9)
    rows = []
    for i in range(800):
        words = [f"{rng.choice(WORDS)}{rng.choice(WORDS)}" for _ in range(rng.randint(40, 120))]
        rows.append((i, " ".join(words) + "." if i % 5 else " ".join(w + "***" for w in words)))
    table = docs(rows + odd_rows()[:3])
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(800)], "doc_id long, quality int")
    out = quality_classifier.quality_classifier(table, labels).collect()
    assert len(out) == 803 and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.doc_id >= 3 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum((r.score >= 0.7) == (r.doc_id % 5 > 0) for r in held) >= 0.95 * len(held)


def test_class_prior_is_near_the_truth():
    rng = np.random.default_rng(4)
    p = rng.normal(1, 0.5, (2000, 12))
    u = np.concatenate([rng.normal(1, 0.5, (1400, 12)), rng.normal(-1, 0.5, (600, 12))])[rng.permutation(2000)]
    assert abs(quality_classifier.class_prior(p, u, rng) - 0.7) < 0.08


def test_quality_without_positives(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality_classifier.quality_classifier(docs(odd_rows()), none).collect()
    assert {r.score for r in out} == {0.5} and len(out) == len(odd_rows())
    assert quality_classifier.quality_classifier(docs([]), none).count() == 0


# --- 6 token counts and 8 BPE

BYTE, WORD_BPE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
HARD = ODD + ["I'll don't they've 're 's", "<|endoftext|> hi<|startoftext|>x  <|endof", "ΣΑΣ İstanbul ﬁ ǅ é",
              "x\x1cy\x85z q", "aaaaaaaaaaaaaaaaaaaaaaaa", "\n\n a \t b\r\n", "👍🏽 ok 123 4５"]


def corpus(spark):
    return [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + HARD


def test_counts_equal_the_library(spark, docs):
    texts = corpus(spark)
    lib = Tokenizer.from_file(BYTE)
    out = {r.doc_id: r for r in token_counts.token_counts(docs(list(enumerate(texts))), BYTE).collect()}
    for i, t in enumerate(texts):
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert (out[i].n_tokens, out[i].over_limit, out[i].n_bytes) == (n, n > 512, len((t or "").encode())), t
    assert token_counts.token_counts(docs([]), BYTE).count() == 0
    assert token_counts.token_counts(docs(odd_rows()), BYTE).count() == len(odd_rows())


def test_every_prefix_equals_the_library():
    rng, lib = random.Random(0), Tokenizer.from_file(BYTE)
    count = token_counts.counter(BYTE)
    parts = ["a", "b", " ", "  ", "\n", "'", "ll", "'re", "é", "1", "!", "the", "<|endoftext|>", " ", "<|e"]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        want = [len(lib.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert count.prefixes(text) == want, text


def test_cut_for_budget(spark, docs):
    rows = [(1, "The cat sat on the mat."), (2, None), (3, "one")]
    out = token_counts.cut_for_budget(token_counts.prefix_counts(docs(rows), BYTE), 3)
    assert {r.doc_id: r.cut for r in out.collect()} == {1: len("The cat sat"), 2: 0, 3: 3}


def test_bpe_equals_the_library_both_ways(spark, docs):
    texts = corpus(spark)
    lib = Tokenizer.from_file(WORD_BPE)
    table = docs(list(enumerate(texts))).withColumn("n_tokens", F.lit("clash"))
    out = bpe.decode(bpe.encode(table, WORD_BPE), WORD_BPE).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = lib.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.token_ids, r.n_tokens) == (ids, len(ids))
        assert r.decoded == lib.decode(ids, skip_special_tokens=False)
    assert bpe.encode(docs([]), WORD_BPE).count() == 0
    assert bpe.digests(docs(odd_rows()), WORD_BPE).count() == len(odd_rows())


def test_digests_equal_hashes_of_the_library(spark, docs):
    rows = list(enumerate(corpus(spark))) + odd_rows()
    out = bpe.digests(docs(rows), WORD_BPE)
    lib = Tokenizer.from_file(WORD_BPE)
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)


def test_every_token_encodes_to_itself_or_what_the_library_says():
    rng, lib = random.Random(1), Tokenizer.from_file(WORD_BPE)
    enc = bpe.encoder(WORD_BPE)
    for _ in range(2000):
        word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzäß") for _ in range(rng.randint(1, 14)))
        assert list(np.frombuffer(enc.encode(word), "<u4")) == lib.encode(word, add_special_tokens=False).ids
