"""Toxicity by a counterfactually regularised classifier.

A logistic model over hashed words and word beginnings.  For each labelled text
that names an identity group, copies with the group swapped for each other one
are made, and the training loss penalises any difference between the scores of
a text and of its copies.  A text that names none gets a neutral mention put to
it, which is then swapped: the text, the text with one group named and the text
with another are to score alike.  So naming a group neutrally raises no score,
also by word beginnings that a group's name shares with other words.

Labels are learned from a bounded sample (MAX_TRAIN ids, by a hash of the id, of
several texts under one id the one with the smallest hash); scoring covers every
row and every word of each text.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm import shared

_log = logging.getLogger(__name__)

MAX_TRAIN = 8000        # labelled rows used for fitting
MAX_FEATURES = 1024     # features kept, by how well they tell the labels apart
MIN_DOCS = 4            # training documents that a feature needs
BEGINNINGS = (4, 5, 6, 7, 8, 10)   # bytes of word beginnings used as features
PENALTY = 1.0           # weight of squared score changes under swaps
L2 = 0.2

# Groups whose terms are swapped for one another (lower case).
IDENTITY_GROUPS = (
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino"), ("immigrants", "natives"), ("immigrant", "native"),
    ("african", "european", "american", "arab", "mexican", "chinese"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "deutsche"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("étrangers", "français"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("extranjeros", "españoles"),
)
_GROUP_OF = {t: (g, i) for g in IDENTITY_GROUPS for i, t in enumerate(g)}
_TERM = re.compile(r"\b(" + "|".join(sorted(map(re.escape, _GROUP_OF), key=len, reverse=True)) + r")\b", re.I)


def fold(key: Column, folds: int) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % folds


def _other(term: str, shift: int) -> str:
    group, at = _GROUP_OF[term.lower()]
    return group[(at + shift) % len(group)]


def swaps(text: str) -> list[str]:
    """Copies of the text with each identity term replaced by another of its
    group, as many as the largest group named has others; all else is as in the
    text.  None at all if it names no group."""
    sizes = [len(_GROUP_OF[m[1].lower()][0]) for m in _TERM.finditer(text)]
    return [_TERM.sub(lambda m, by=shift: _other(m[1], by), text) for shift in range(1, max(sizes, default=1))]


def features(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct feature hashes of each document."""
    w = shared.Words(data, offsets, lower=True, letters=True)
    ids = w.hashes()
    parts = [(ids, np.arange(len(ids)))] + [w.prefix_hashes(n) for n in BEGINNINGS]
    out = []
    for d in range(len(offsets) - 1):
        a, b = w.range[d], w.range[d + 1]
        if a == b:
            out.append(np.empty(0, np.uint64))
            continue
        own = [v[np.searchsorted(at, a):np.searchsorted(at, b)] for v, at in parts]
        out.append(np.unique(np.concatenate(own)))
    return out


def _features_of(col: pa.Array) -> list[np.ndarray]:
    data, offsets = shared.text_buffer(col)
    out = []
    for i, j in shared.doc_chunks(offsets):
        out += features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
    return out


def _known(selected: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Positions in ``selected`` (sorted) of the features found."""
    if len(selected) == 0 or len(found) == 0:
        return np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(selected, found), len(selected) - 1)
    return at[selected[at] == found]


def _select(sample: DataFrame) -> np.ndarray:
    """The features that best tell the labels apart (likelihood ratio)."""
    def run(batches):
        for b in shared.small_batches(batches, 0):
            feats, y = _features_of(b.column(0)), np.asarray(b.column(1))
            if not feats:
                continue
            flat, back = np.unique(np.concatenate(feats), return_inverse=True)
            weight = np.repeat(y, [len(f) for f in feats])
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat.view(np.int64)), pa.array(np.bincount(back, minlength=len(flat)), pa.int64()),
                 pa.array(np.bincount(back, weight, minlength=len(flat)).astype(np.int64))],
                names=["feature", "n", "pos"])

    totals = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    n_all, n_pos = int(totals[0]), int(totals[1])
    if n_pos == 0 or n_pos == n_all:
        return np.empty(0, np.uint64)
    rate = n_pos / n_all
    n, p = F.col("n").cast("double"), F.col("pos").cast("double")

    def part(count, expected):
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    gain = part(p, n * rate) + part(n - p, n * (1 - rate))
    rows = (sample.mapInArrow(run, "feature long, n long, pos long").groupBy("feature")
            .agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).where(F.col("n") >= MIN_DOCS)
            .withColumn("gain", gain).where("gain > 4")
            .orderBy(F.desc("gain"), "feature").limit(MAX_FEATURES).select("feature").collect())
    return np.sort(np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64))


def _training_rows(sample: DataFrame, selected: np.ndarray) -> list:
    """Per training row: label, its features, and those of its swapped copies."""
    def run(batches):
        for b in shared.small_batches(batches, 0):
            found = [_known(selected, f) for f in _features_of(b.column(0))]
            copies = []
            for t in b.column(0):
                made = swaps(t.as_py() or "")
                copies.append([_known(selected, f).tolist() for c in made
                               for f in _features_of(pa.array([c], pa.string()))])
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array([f.tolist() for f in found], pa.list_(pa.int64())),
                 pa.array(copies, pa.list_(pa.list_(pa.int64())))], names=["label", "own", "swapped"])

    return sample.mapInArrow(run, "label long, own array<long>, swapped array<array<long>>").collect()


def mentions(selected: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Selected features of each term and of the next one of its group, where
    there are any."""
    terms = list(_GROUP_OF)
    both = _features_of(pa.array(terms + [_other(t, 1) for t in terms], pa.string()))
    known = [_known(selected, f) for f in both]
    return [(a, b) for a, b in zip(known[:len(terms)], known[len(terms):], strict=True) if len(a) or len(b)]


def changes(rows: list, selected: np.ndarray) -> tuple[np.ndarray, int]:
    """Sum of the outer products of all feature changes under swaps (so its size
    is that of the features, not of the rows), and the number of changes."""
    width, n = len(selected), 0
    total = np.zeros((width, width), dtype=np.float32)
    put = mentions(selected)

    def add(one: np.ndarray, other: np.ndarray) -> int:
        plus, minus = np.setdiff1d(one, other), np.setdiff1d(other, one)
        at = np.concatenate([plus, minus]).astype(np.int64)
        sign = np.repeat([1.0, -1.0], [len(plus), len(minus)]).astype(np.float32)
        total[np.ix_(at, at)] += np.outer(sign, sign)
        return int(len(at) > 0)

    for r in rows:
        own = np.array(r["own"], dtype=np.int64)
        for copy in r["swapped"]:
            n += add(own, np.array(copy, dtype=np.int64))
        if not r["swapped"]:
            for a, b in put:
                named = np.union1d(own, a)
                n += add(own, named) + add(named, np.union1d(own, b))
    return total, n


def fit(x: np.ndarray, y: np.ndarray, changed: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression; ``changed``: summed outer products of the feature
    changes between texts and their copies, whose effect on the score is
    penalised."""
    n, k = x.shape
    x, changed, y = x.astype(np.float32), changed.astype(np.float32), y.astype(np.float32)
    w = np.zeros(k, dtype=np.float32)
    bias = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    m, v = np.zeros(k + 1, dtype=np.float32), np.zeros(k + 1, dtype=np.float32)
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30)))
        err = (p - y) / n
        grad = x.T @ err + L2 / n * w + PENALTY / n * (changed @ w)
        g = np.append(grad, err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        d = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, bias = w - d[:-1], bias - float(d[-1])
    return w.astype(float), bias


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic") -> dict:
    """Model from labelled rows outside fold 0 of 5 (crc32 of the id).  At most
    MAX_TRAIN labels are joined, so their broadcast is bounded."""
    chosen = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & (fold(F.col(key), 5) != 0))
              .groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("long").alias("label"))
              .orderBy(F.xxhash64("_key"), "_key").limit(MAX_TRAIN))
    sample = shared.written(
        docs.select(F.col(key).alias("_key"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(chosen), "_key")
        .groupBy("_key").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "label")).alias("row"))
        .select("row.text", "row.label"), "toxicity-sample")
    selected = _select(sample)
    rows = _training_rows(sample, selected)
    y = np.array([r["label"] for r in rows], dtype=float)
    if len(selected) == 0:
        return {"selected": selected, "w": np.empty(0), "bias": _base_logit(y)}
    x = np.zeros((len(rows), len(selected)), dtype=np.float32)
    for i, r in enumerate(rows):
        x[i, r["own"]] = 1
    changed, n = changes(rows, selected)
    _log.info("%d training rows, %d features, %d changes under swaps", len(rows), len(selected), n)
    w, bias = fit(x, y, changed)
    return {"selected": selected, "w": w, "bias": bias}


def _base_logit(y: np.ndarray) -> float:
    rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.1
    return float(np.log(rate / (1 - rate)))


def score(docs: DataFrame, model: dict, key: str = "doc_id") -> DataFrame:
    """``key`` and ``score`` of every row; null and empty texts get the score
    that the bias alone gives."""
    selected, w, bias = model["selected"], model["w"], model["bias"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in shared.small_batches(batches, 1):
            z = np.array([bias + w[_known(selected, f)].sum() for f in _features_of(b.column(1))])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())],
                names=[key, "score"])

    src = docs.select(F.col(key), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, f"{key} {src.schema[key].dataType.simpleString()}, score double")


def keep_clean(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns
    of the others unchanged."""
    names = docs.columns
    at = names.index("text")
    selected, w, bias = model["selected"], model["w"], model["bias"]
    limit = float(np.log(threshold / (1 - threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in shared.small_batches(batches, at):
            z = [bias + w[_known(selected, f)].sum() for f in _features_of(b.column(at))]
            yield b.filter(pa.array([bool(v < limit) for v in z], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
