"""Runs (maximal repetitions) of words, found through Lyndon roots.

Phase one of Baier's suffix sorter groups the suffixes of a word sequence by
their longest Lyndon prefix; the length of a suffix's group context is its
entry of the Lyndon array, so no suffix array is needed.  It is run under the
order of the words and under the reverse order: every run has a root that is an
entry of one of the two arrays.  Each entry is extended to both sides by longest
common extensions; it is a run if the result holds the root twice.

A run of at least ``MIN_LENGTH`` words and two periods repeats each of its words
inside a window of ``MIN_LENGTH // 2`` words that occurs twice in the text, and so lies
within one stretch of such windows.  Only those stretches are sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm import shared

MIN_LENGTH = 12
_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_PRIMES = (np.uint64(2147483647), np.uint64(2147483629))
_BASES = (np.uint64(1234567891), np.uint64(987654323))


def lyndon_array(symbols: list[int]) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each position, by the
    grouping phase of Baier's suffix sorter, in linear time.

    Groups are taken from the highest; ``left`` and ``right`` link the
    positions whose group is still to come.  A position that the current group
    follows ``times`` times in a row gets a longer context and moves into a new
    group just above its old one.
    """
    n = len(symbols)
    rank = {s: k for k, s in enumerate(sorted(set(symbols)))}
    members: list[list[int]] = [[] for _ in rank]
    group = [rank[s] for s in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    context = [1] * len(rank)
    below = list(range(-1, len(rank) - 1))
    above = [*range(1, len(rank)), -1]
    left = list(range(-1, n))
    right = list(range(1, n + 1))
    out = np.empty(n, dtype=np.int64)
    current = len(rank) - 1
    while current >= 0:
        own = [i for i in members[current] if group[i] == current]
        members[current] = []
        if own:
            width = context[current]
            out[own] = width
            followed: dict[int, int] = {}
            for i in own:
                a, b = left[i], right[i]
                left[b] = a
                if a >= 0:
                    right[a] = b
                    followed[a] = followed.get(a, 0) + 1
            moves: dict[tuple[int, int], list[int]] = {}
            for a, times in followed.items():
                moves.setdefault((-times, group[a]), []).append(a)
            for (times, old), moved in sorted(moves.items()):
                new = len(members)
                members.append(moved)
                context.append(context[old] - times * width)
                up = above[old]
                below.append(old)
                above.append(up)
                above[old] = new
                if up >= 0:
                    below[up] = new
                for a in moved:
                    group[a] = new
        current = below[current]
    return out


class _Common:
    """Longest common extensions of position pairs, by binary search over
    prefix sums modulo two primes."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.sums, self.powers = [], []
        value = symbols.astype(np.uint64) + np.uint64(1)
        for p, base in zip(_PRIMES, _BASES, strict=True):
            power = np.ones(self.n + 1, dtype=np.uint64)
            have = 1
            step = base
            while have <= self.n:           # powers by doubling
                more = min(have, self.n + 1 - have)
                power[have:have + more] = power[:more] * step % p
                have += more
                step = step * step % p
            sums = np.zeros(self.n + 1, dtype=np.uint64)
            np.cumsum(value % p * power[:-1] % p, out=sums[1:])
            self.sums.append(sums % p)
            self.powers.append(power)

    def _equal(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        same = np.ones(len(i), dtype=bool)
        for p, sums, power in zip(_PRIMES, self.sums, self.powers, strict=True):
            one = (sums[i + size] + p - sums[i]) % p * power[j - i] % p
            same &= one == (sums[j + size] + p - sums[j]) % p
        return same

    def _search(self, equal, most: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if len(open_) == 0:
                return low
            mid = (low[open_] + high[open_] + 1) // 2
            ok = equal(open_, mid)
            low[open_[ok]] = mid[ok]
            high[open_[~ok]] = mid[~ok] - 1

    def after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at i < j."""
        return self._search(lambda at, size: self._equal(i[at], j[at], size), self.n - j)

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common suffix of the prefixes that end before i < j."""
        return self._search(lambda at, size: self._equal(i[at] - size, j[at] - size, size), i.copy())


def runs_of(symbols: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """All runs of at least ``min_length`` symbols as rows (start, length,
    period), by start, then period.  An extension that a hash collision made
    too long is found by comparing the symbols and measured again."""
    n = len(symbols)
    if n < min_length:
        return np.empty((0, 3), dtype=np.int64)
    common = _Common(symbols)
    found = []
    position = np.arange(n)
    for order in (symbols, -symbols):
        period = lyndon_array(order.tolist())
        at = np.flatnonzero(position + period < n)
        i, p = position[at], period[at]
        forth, back = common.after(i, i + p), common.before(i, i + p)
        length = back + p + forth
        good = length >= np.maximum(min_length, 2 * p)
        found.append(np.stack([i - back, length, p], axis=1)[good])
    rows = np.unique(np.concatenate(found), axis=0)
    wrong = [not np.array_equal(symbols[s:s + size - p], symbols[s + p:s + size]) for s, size, p in rows.tolist()]
    if any(wrong):
        rows = _plain(symbols, rows[np.array(wrong)], rows[~np.array(wrong)], min_length)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _plain(symbols: np.ndarray, doubtful: np.ndarray, sure: np.ndarray, min_length: int) -> np.ndarray:
    """The true runs within ``doubtful`` ones: stretches of equal symbols at
    the distance of the period, that no shorter period explains."""
    out = [tuple(r) for r in sure.tolist()]
    for p in sorted(set(doubtful[:, 2].tolist())):
        same = np.concatenate([[False], symbols[:-p] == symbols[p:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
        for s, e in edge.tolist():
            size = e - s + p
            word = symbols[s:s + p]
            if size >= max(min_length, 2 * p) and not any(
                    p % q == 0 and np.array_equal(word[:-q], word[q:]) for q in range(1, p)):
                out.append((s, size, p))
    return np.array(sorted(set(out)), dtype=np.int64).reshape(-1, 3)


def _stretches(words: shared.Words, hashes: np.ndarray, width: int) -> np.ndarray:
    """Flags of the words that lie in a window of ``width`` words which occurs
    twice or more in its text."""
    flags = np.zeros(len(hashes) + 1, dtype=np.int64)
    if len(hashes) < width:
        return flags[:-1] > 0
    doc = np.repeat(np.arange(len(words.range) - 1), np.diff(words.range)).astype(np.uint64)
    windows = shared.window_hashes(hashes, width)
    inside = np.flatnonzero(doc[:len(windows)] == doc[width - 1:])
    key = shared.mix64(windows[inside] ^ (doc[inside] * np.uint64(0x9E3779B97F4A7C15)))
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    start = inside[count[which] > 1]
    np.add.at(flags, start, 1)
    np.add.at(flags, start + width, -1)
    return np.cumsum(flags)[:-1] > 0


def runs_of_texts(texts: list[bytes], min_length: int = MIN_LENGTH) -> tuple[list[np.ndarray], list[list[bytes]]]:
    """Runs of each text and its words.  The stretches of all texts are sorted
    as one sequence, each ended by a symbol of its own."""
    split = [t.split() for t in texts]      # at space, \t, \n, \v, \f and \r
    data = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    words = shared.Words(data, np.minimum(offsets, len(data)))
    flags = _stretches(words, words.hashes(), max(1, min_length // 2))
    # stretches of flagged words, cut where a text ends
    doc_of = np.repeat(np.arange(len(texts)), np.diff(words.range))
    change = np.flatnonzero(np.concatenate([[True], (flags[1:] != flags[:-1]) | (doc_of[1:] != doc_of[:-1]), [True]])
                            ) if len(flags) else np.zeros(1, np.int64)
    begin, end = change[:-1], change[1:]
    begin, end = begin[flags[begin]], end[flags[begin]]
    doc = doc_of[begin]
    number: dict[bytes, int] = {}
    symbols: list[int] = []
    origin: list[int] = []
    owner: list[int] = []
    for d, s, e in zip(doc.tolist(), begin.tolist(), end.tolist(), strict=True):
        if e - s < min_length:
            continue
        first = int(words.range[d])
        symbols += [number.setdefault(w, len(number)) for w in split[d][s - first:e - first]]
        symbols.append(-len(origin) - 1)
        origin += range(s - first, e - first + 1)
        owner += [d] * (e - s + 1)
    found: list[list] = [[] for _ in texts]
    if symbols:
        at = np.array(symbols, dtype=np.int64)
        at = np.where(at < 0, len(number) - at, at)
        for s, size, p in runs_of(at, min_length).tolist():
            found[owner[s]].append((origin[s], size, p))
    return [np.array(sorted(f, key=lambda r: (r[0], r[2])), dtype=np.int64).reshape(-1, 3) for f in found], split


def _kept(words: list[bytes], runs: np.ndarray) -> bytes:
    if len(runs) == 0:
        return b" ".join(words)
    flags = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(flags, runs[:, 0] + runs[:, 2], 1)
    np.add.at(flags, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(flags[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with ``runs`` (start, length and period in words, by start, then
    period) and ``collapsed`` (the words that no run repeats, joined by one
    space) added; columns of these names are replaced, all others kept.

    Words are runs of characters other than ASCII white space.  Null, empty and
    blank texts have no runs and collapse to the empty text.  Repeated rows and
    null keys are treated row by row.  A text is worked on whole, in memory that
    grows with its length.
    """
    src = docs.drop("runs", "collapsed")
    names = src.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in shared.small_batches(batches, at):
            texts = [(t or "").encode() for t in b.column(at).to_pylist()]
            runs, words = runs_of_texts(texts, min_length)
            ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            flat = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
            items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN))
            kept = pa.array([_kept(w, r) for w, r in zip(words, runs, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.ListArray.from_arrays(pa.array(ends), items), kept.cast(pa.string())],
                names=[*names, "runs", "collapsed"])

    return src.mapInArrow(run, shared.extended(src, runs=_RUNS, collapsed="string"))


def _repeated(doc_id: Column, text: Column) -> Column:
    """One text in ten with a part repeated to its end, as the query asks for;
    a null doc_id changes nothing."""
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"))
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    part = F.slice(words, a + 1, p)
    turns = F.ceil((n - a) / p).cast("int")
    again = F.concat(F.slice(words, F.lit(1), a), F.slice(F.flatten(F.array_repeat(part, turns)), F.lit(1), n - a))
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), F.array_join(again, " ")).otherwise(text)


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", _repeated(F.col("doc_id"), F.col("text")).alias("text"))
    runs = F.col("runs")
    first = F.array_sort(runs, lambda a, b: F.when(a["length"] != b["length"], F.signum(b["length"] - a["length"]))
                         .when(a["start"] != b["start"], F.signum(a["start"] - b["start"]))
                         .otherwise(F.signum(a["period"] - b["period"])).cast("int"))
    best = F.get(F.col("best"), F.lit(0))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"))), "")
    return (periodic_runs(docs).withColumn("best", first)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                    best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
                    F.expr("(1000 * get(best, 0).length) div get(best, 0).period").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
