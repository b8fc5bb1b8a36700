"""Quality by positive-unlabelled learning.

A small network over measures of a text is trained on trusted positives and on
unlabelled web text only.  It minimises the non-negative unbiased risk
``pi * E_p[loss(+)] + max(0, E_u[loss(-)] - pi * E_p[loss(-)])``, where the
class prior pi is estimated first: the ratio of unlabelled to positive mass where
a plain positive-versus-unlabelled model is surest, on rows it has not seen.

Training reads at most MAX_POSITIVE positives and MAX_UNLABELLED unlabelled
rows (by a hash of the id); all rows are scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm import quality_rules, shared
from tributary.llm.toxicity import fold

MAX_POSITIVE = 5_000
MAX_UNLABELLED = 10_000
HIDDEN = 16
PRIOR_MARGIN = 0.03
ROUNDS = 400
_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words",
            "n_adjacent_repeats", "n_upper", "n_bare", "n_plain", "n_lines"]


def inputs(m: dict[str, np.ndarray]) -> np.ndarray:
    """Network inputs: shares of each measure, and sizes on a log scale."""
    f = {k: np.asarray(v, dtype=float) for k, v in m.items()}
    n, chars = np.maximum(f["n_words"], 1), np.maximum(f["word_chars"], 1)
    return np.stack([
        np.log1p(f["n_words"]) / 5, chars / n / 5, np.minimum(f["n_symbols"] / n, 4),
        f["n_dup_lines"] / np.maximum(f["n_lines"], 1), f["n_repeat_words"] / n,
        f["n_distinct_words"] / n, f["n_adjacent_repeats"] / n, f["n_upper"] / chars * 3,
        f["n_bare"] / n, f["n_plain"] / n, np.log1p(f["n_words"] / np.maximum(f["n_lines"], 1)) / 4,
        (f["n_words"] < 20).astype(float)], axis=1)


class Network:
    """One hidden layer; weights are plain arrays that travel with the tasks."""

    def __init__(self, mean, scale, rng):
        k = len(mean)
        self.mean, self.scale = mean, scale
        self.p = [rng.normal(0, 1 / np.sqrt(k), (k, HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]

    def _hidden(self, x):
        return np.tanh((x - self.mean) / self.scale @ self.p[0] + self.p[1])

    def logit(self, x):
        return self._hidden(x) @ self.p[2] + self.p[3][0]

    def step(self, x, slope, state, rate=0.01, decay=1e-4):
        """One Adam step along ``slope``, the loss derivative by logit."""
        z = (x - self.mean) / self.scale
        h = np.tanh(z @ self.p[0] + self.p[1])
        back = np.outer(slope, self.p[2]) * (1 - h * h)
        grads = [z.T @ back, back.sum(0), h.T @ slope, np.array([slope.sum()])]
        state["t"] = t = state.get("t", 0) + 1
        for i, g in enumerate(grads):
            g = g + decay * self.p[i]
            m = state[i, 0] = 0.9 * state.get((i, 0), 0) + 0.1 * g
            v = state[i, 1] = 0.999 * state.get((i, 1), 0) + 0.001 * g * g
            self.p[i] = self.p[i] - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, rng) -> float:
    """Share of positives in the unlabelled rows.  A plain model is fitted to
    tell the two samples apart on one half and read on the other, both ways
    round; where it is surest of "positive", hardly any negatives are left, so
    the ratio of masses there is the prior.  A prior that is too large makes the
    non-negative risk accept negatives, one that is too small only lowers all
    scores a little: the estimate less PRIOR_MARGIN and two standard errors is
    used."""
    ratios, seen = [], 0
    for one, two in ((0, 1), (1, 0)):
        (p_fit, p), (u_fit, u) = ((a[one::2], a[two::2]) for a in (positive, unlabelled))
        if len(p) == 0 or len(u) == 0 or len(p_fit) == 0 or len(u_fit) == 0:
            return 0.5
        x = np.concatenate([p_fit, u_fit])
        net, state = Network(x.mean(0), x.std(0) + 1e-6, rng), {}
        y = np.concatenate([np.ones(len(p_fit)), np.zeros(len(u_fit))])
        weight = np.where(y == 1, 0.5 / len(p_fit), 0.5 / len(u_fit))
        for _ in range(ROUNDS // 2):
            net.step(x, weight * (_sigmoid(net.logit(x)) - y), state)
        p, u = net.logit(p), net.logit(u)
        for c in np.quantile(p, np.linspace(0.1, 0.5, 9)):
            ratios.append((u >= c).mean() / max((p >= c).mean(), 1e-9))
        seen += min(len(p), len(u))
    prior = float(np.median(ratios))
    return float(np.clip(prior * (1 - PRIOR_MARGIN) - 2 * np.sqrt(0.25 / max(seen, 1)), 0.05, 0.95))


def fit(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 5) -> tuple[Network, float]:
    rng = np.random.default_rng(seed)
    prior = class_prior(positive, unlabelled, rng)
    x = np.concatenate([positive, unlabelled])
    net, state, n_p = Network(x.mean(0), x.std(0) + 1e-6, rng), {}, len(positive)
    for _ in range(ROUNDS):
        z = net.logit(x)
        s = _sigmoid(z)
        loss_minus = np.logaddexp(0, z)
        negative = loss_minus[n_p:].mean() - prior * loss_minus[:n_p].mean()
        plus = prior * (s[:n_p] - 1) / n_p             # derivative of pi * E_p[loss(+)]
        minus_u, minus_p = s[n_p:] / len(unlabelled), -prior * s[:n_p] / n_p
        if negative >= 0:
            slope = np.concatenate([plus + minus_p, minus_u])
        else:       # the unbiased estimate went below zero: step back up
            slope = -np.concatenate([minus_p, minus_u])
        net.step(x, slope, state)
    return net, prior


def train(measured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Network | None:
    """Positives: rows labelled 1 outside fold 2 of 4 (crc32 of the id), one per
    id (the smallest measures), so that at most MAX_POSITIVE reach the driver.
    Unlabelled: any rows, without their labels.  None without both."""
    good = (labels.where((F.col(label) == 1) & F.col(key).isNotNull() & (fold(F.col(key), 4) != 2))
            .select(F.col(key).alias("_key")).distinct()
            .orderBy(F.xxhash64("_key"), "_key").limit(MAX_POSITIVE))
    p = (measured.join(F.broadcast(good), F.col(key) == F.col("_key")).groupBy("_key")
         .agg(F.min(F.struct(*_COLUMNS)).alias("row")).select("row.*").toArrow())
    u = measured.orderBy(F.xxhash64(F.col(key), F.lit(3)), key).limit(MAX_UNLABELLED).select(*_COLUMNS).toArrow()
    if p.num_rows == 0 or u.num_rows == 0:
        return None
    as_dict = [{c: np.asarray(t[c]) for c in _COLUMNS} for t in (p, u)]
    return fit(inputs(as_dict[0]), inputs(as_dict[1]))[0]


def score(measured: DataFrame, net: Network | None, key: str = "doc_id") -> DataFrame:
    """``key`` and ``score`` of every row of measures; without a model 0.5."""
    kind = measured.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = inputs({c: np.asarray(b.column(i + 1)) for i, c in enumerate(_COLUMNS)})
            s = np.full(len(x), 0.5) if net is None else _sigmoid(net.logit(x))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=[key, "score"])

    return measured.select(key, *_COLUMNS).mapInArrow(run, f"{key} {kind}, score double")


def quality_classifier(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` and ``score`` (0 to 1) of every row.  Null and empty texts are
    scored like a text of no words; repeated rows get one row each; extra
    columns are not read."""
    measured = shared.written(quality_rules.measures(docs, "text", key), "quality-inputs")
    return score(measured, train(measured, labels, key), key)


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    scored = quality_classifier(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                                spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))
