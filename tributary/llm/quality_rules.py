"""Quality rules as weak supervision.

Every rule votes good (+1), bad (-1) or abstains (0) on a document.  The rules'
accuracies on the hidden good / bad class are estimated by
expectation-maximisation from the votes alone, and a document is kept by its
posterior probability of being good, not by passing every rule.

Only the counts of distinct vote patterns reach the driver: at most
``3 ** len(rules())`` rows, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm import shared

WINDOW = 8          # words of a window that counts as repeated
SYMBOLS = b"#*$%&|<>"
# prior accuracies on good and bad documents, the prior share of good ones, and
# what these priors weigh as a share of the corpus
PRIOR_GOOD, GOOD_WEIGHT = 0.985, 0.25
PRIOR_BAD, BAD_WEIGHT = 0.35, 0.02
PRIOR_SHARE = 0.85

_FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MORE = ["n_distinct_words", "n_adjacent_repeats", "n_upper", "n_bare", "n_plain", "n_lines"]

_IS_SYMBOL = np.zeros(256, dtype=np.int64)
_IS_SYMBOL[list(SYMBOLS)] = 1
_IS_UPPER = np.zeros(256, dtype=np.int64)
_IS_UPPER[65:91] = 1
_IS_LETTER = np.zeros(256, dtype=np.int64)
_IS_LETTER[65:91] = 1
_IS_LETTER[97:123] = 1
_IS_LETTER[128:] = 1
_IS_MARK = np.zeros(256, dtype=bool)
_IS_MARK[list(b".,;:!?'\"")] = True
_IS_START = np.ones(256, dtype=np.int64)   # first byte of a code point
_IS_START[128:192] = 0


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _duplicate_lines(raw: bytes) -> int:
    seen, n = set(), 0
    for line in raw.split(b"\n"):
        if line.strip(b" \t\n\x0b\x0c\r"):
            if line in seen:
                n += 1
            seen.add(line)
    return n


def _measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    w = shared.Words(data, offsets)
    ids = w.hashes()
    n_words = np.diff(w.range)
    docs = len(offsets) - 1
    out = {
        "n_words": n_words,
        "word_chars": _per_doc(_IS_START[data] * w.word, offsets),
        "n_symbols": _per_doc(_IS_SYMBOL[data], offsets),
        "n_upper": _per_doc(_IS_UPPER[data], offsets),
        "n_lines": _per_doc((data == 10).astype(np.int64), offsets) + 1,
    }
    letters = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_IS_LETTER[data], out=letters[1:])
    inner = w.end - 1
    plain = ((letters[inner] - letters[w.start] == inner - w.start)
             & ((letters[w.end] > letters[inner]) | _IS_MARK[data[inner]] & (inner > w.start)))
    out["n_plain"] = _per_doc(plain.astype(np.int64), w.range)
    out["n_bare"] = _per_doc((letters[w.end] == letters[w.start]).astype(np.int64), w.range)
    repeat, distinct, adjacent, dup = (np.zeros(docs, dtype=np.int64) for _ in range(4))
    for i in range(docs):
        own = ids[w.range[i]:w.range[i + 1]]
        if len(own) == 0:
            continue
        distinct[i] = len(np.unique(own))
        adjacent[i] = int((own[1:] == own[:-1]).sum())
        if len(own) > WINDOW:
            win = shared.window_hashes(own, WINDOW)
            _, back, count = np.unique(win, return_inverse=True, return_counts=True)
            hit = np.flatnonzero(count[back] > 1)
            if len(hit):
                cover = np.zeros(len(own) + 1, dtype=np.int64)
                np.add.at(cover, hit, 1)
                np.add.at(cover, hit + WINDOW, -1)
                repeat[i] = int((np.cumsum(cover[:-1]) > 0).sum())
        if out["n_lines"][i] > 1:
            dup[i] = _duplicate_lines(data[offsets[i]:offsets[i + 1]].tobytes())
    return out | {"n_repeat_words": repeat, "n_distinct_words": distinct,
                  "n_adjacent_repeats": adjacent, "n_dup_lines": dup}


def measures(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of counts per input row (repeated rows give repeated rows; a
    null text counts as no words and no lines with a word)."""
    names = _FEATURES + _MORE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = shared.text_buffer(b.column(1))
            parts = []
            for i, j in shared.doc_chunks(offsets):
                parts.append(_measure(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
            if not parts:
                continue
            cols = [pa.array(np.concatenate([p[n] for p in parts]), pa.int64()) for n in names]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=[key, *names])

    src = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
    kind = src.schema[key].dataType.simpleString()
    return src.mapInArrow(run, f"{key} {kind}, " + ", ".join(f"{n} long" for n in names))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The voting rules, over the columns of ``measures``."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    few = F.col("n_words") < 20
    return {
        "length": _vote((F.col("n_words") >= 40) & (F.col("n_words") <= 100_000), few),
        "symbols": _vote(F.col("n_symbols") * 100 <= n, F.col("n_symbols") * 10 > n),
        "plain_words": _vote(F.col("n_plain") * 10 >= n * 9, F.col("n_plain") * 4 < n * 3),
        "repeats": _vote(F.col("n_repeat_words") * 20 <= n, F.col("n_repeat_words") * 4 > n),
        "vocabulary": _vote((F.col("n_distinct_words") * 100 >= n * 50) & ~few,
                            (F.col("n_distinct_words") * 100 < n * 30) & (n < 5000)),
        "stutter": _vote(F.col("n_adjacent_repeats") * 50 <= n, F.col("n_adjacent_repeats") * 8 > n),
        "shouting": _vote(F.col("n_upper") * 12 <= chars, F.col("n_upper") * 5 > chars),
        "bare_marks": _vote(F.col("n_bare") * 50 <= n, F.col("n_bare") * 8 > n),
        "word_length": _vote((chars >= n * 3) & (chars <= n * 10), (chars < n * 2) | (chars > n * 14)),
        "line_repeats": _vote(F.col("n_dup_lines") * 20 <= F.col("n_lines"),
                              F.col("n_dup_lines") * 4 > F.col("n_lines")),
    }


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, tol: float = 1e-9) -> dict:
    """EM over vote patterns (rows of -1 / 0 / +1) and their counts.

    Per rule: the chance that a vote is right on a good document and on a bad
    one (abstaining carries no evidence), and the share of good documents.
    Beta priors keep each rule better than chance, so the classes cannot swap.
    """
    k = patterns.shape[1]
    total = float(counts.sum())
    up, down = patterns > 0, patterns < 0
    voted = up | down
    strong, weak = max(1.0, GOOD_WEIGHT * total), max(1.0, BAD_WEIGHT * total)
    share, right_good, right_bad = PRIOR_SHARE, np.full(k, PRIOR_GOOD), np.full(k, PRIOR_BAD)
    last = None
    for _ in range(rounds):
        post = _posterior(up, down, share, right_good, right_bad)
        good, bad = post * counts, (1 - post) * counts
        share = (good.sum() + PRIOR_SHARE * weak) / (total + weak)
        right_good = (good @ up + PRIOR_GOOD * strong) / (good @ voted + strong)
        right_bad = (bad @ down + PRIOR_BAD * weak) / (bad @ voted + weak)
        now = np.concatenate([[share], right_good, right_bad])
        if last is not None and np.abs(now - last).max() < tol:
            break
        last = now
    return {"share_good": float(share), "right_good": right_good, "right_bad": right_bad}


def _posterior(up, down, share, right_good, right_bad) -> np.ndarray:
    logit = (np.log(share) - np.log(1 - share)
             + up @ (np.log(right_good) - np.log1p(-right_bad))
             + down @ (np.log1p(-right_good) - np.log(right_bad)))
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def posterior_column(model: dict, votes: list[str]) -> Column:
    """Posterior of "good" as a Spark expression over the vote columns."""
    logit = F.lit(float(np.log(model["share_good"]) - np.log(1 - model["share_good"])))
    for name, a, b in zip(votes, model["right_good"], model["right_bad"], strict=True):
        logit = logit + (F.when(F.col(name) > 0, float(np.log(a) - np.log1p(-b)))
                         .when(F.col(name) < 0, float(np.log1p(-a) - np.log(b))).otherwise(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def quality_rules(docs: DataFrame, text: str = "text", key: str = "doc_id",
                  threshold: float = 0.5) -> DataFrame:
    """Counts, votes, posterior and verdict of every row of ``docs``.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in
    repeated 8-word windows; such rows are never kept.  Otherwise ``kept`` is
    ``p_good >= threshold``.  Null or empty text: no words, so base_failed.
    Only ``key`` and ``text`` are read, so other columns cannot clash.  An
    empty input gives an empty result.
    """
    table = shared.written(measures(docs, text, key), "quality-measures")
    votes = rules()
    voted = table.withColumns({f"vote_{n}": c.cast("int") for n, c in votes.items()})
    names = [f"vote_{n}" for n in votes]
    seen = voted.groupBy(*names).count().collect()   # at most 3 ** len(votes) patterns
    patterns = np.array([[r[n] for n in names] for r in seen], dtype=np.int64).reshape(-1, len(names))
    model = fit(patterns, np.array([r["count"] for r in seen], dtype=float))
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return (voted.withColumn("p_good", posterior_column(model, names))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("p_good") >= threshold)))


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_rules(docs).select("doc_id", *_FEATURES, "p_good", "base_failed", "kept")
