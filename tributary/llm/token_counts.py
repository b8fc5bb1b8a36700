"""Exact token counts of every prefix, by dynamic programming.

Within a pre-token, the last token of the encoding of each prefix is the one
token that ends there and fits the last token of the prefix before it; so the
count at a prefix is the count before that token, plus one.  Counts at all
prefixes answer "how many tokens", "where to cut for a budget" and "is it over
the limit" without encoding again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.bpe_tables import SPAN, MergeTable, Remembered, merge_table
from tributary.llm.shared import small_batches

# Fixed value: the vocabulary's split of text into pre-tokens (\s spelled out).
PIECE_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
                 r"| ?[^\p{White_Space}\p{L}\p{N}]+"
                 r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
CONTRACTIONS = {"'re", "'ve", "'ll"}   # those that can be cut inside
# new entries after which a Python worker forgets (about 200 bytes each)
CACHE_PIECES = 100_000
CACHE_RUNS = 250_000
_TOUCHING = re.compile(r" \s|\s ")


def prefix_table(table: MergeTable, units: str) -> list[int]:
    """Token count of every prefix of one pre-token: entry i is that of its
    first i units."""
    n = len(units)
    last = [-1] * (n + 1)
    count = [0] * (n + 1)
    known = table.known
    for end, (token, length) in table.automaton.iter(units):
        end += 1
        if last[end] >= 0:
            continue
        start = end - length
        if start:
            left = last[start]
            fit = known.get(left * SPAN + token)
            if not (table.fits(left, token) if fit is None else fit):
                continue
        last[end] = token
        count[end] = count[start] + 1
    return count


class Counter:
    def __init__(self, path: str):
        self.table = merge_table(path)
        self.find = regex.compile(PIECE_PATTERN).findall
        self.totals = Remembered(self._total, CACHE_PIECES)
        self.runs = Remembered(lambda run: self.fresh(" " + run), CACHE_RUNS)
        added = sorted(self.table.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None

    def _total(self, piece: str) -> int:
        return prefix_table(self.table, self.table.units(piece.encode()))[-1]

    def _plain(self, text: str) -> int:
        # a space that touches no other white space always starts a pre-token,
        # so what stands between such spaces is looked up whole
        if _TOUCHING.search(text):
            return self.fresh(text)
        first, *rest = text.split(" ")
        return self.fresh(first) + sum(map(self.runs.__getitem__, rest))

    def fresh(self, text: str) -> int:
        return sum(map(self.totals.__getitem__, self.find(text)))

    def total(self, text: str) -> int:
        if self.added is None or "<" not in text:
            return self._plain(text)
        return sum(1 if k % 2 else self._plain(part) for k, part in enumerate(self.added.split(text)))

    def _piece(self, piece: str) -> list[int]:
        """Counts at the code point boundaries of one piece (first: 0)."""
        counts = prefix_table(self.table, self.table.units(piece.encode()))
        if piece.isascii():
            return counts
        ends = np.cumsum([0] + [len(c.encode()) for c in piece])
        return [counts[e] for e in ends]

    def _plain_prefixes(self, text: str) -> list[int]:
        out, done, before, spaces = [0], 0, 0, ""
        for piece in self.find(text):
            counts = self._piece(piece)
            if piece in CONTRACTIONS:   # cut inside, it is a mark and a letter
                counts[2] = self.totals["'"] + self.totals[piece[1]]
            own = [done + c for c in counts[1:]]
            if spaces and piece[0].isspace():   # cut here, the white space is one run
                own[0] = before + self.totals[spaces + piece[0]]
            out += own
            before, done = done, done + counts[-1]
            spaces = piece if piece.isspace() else ""
        return out

    def prefixes(self, text: str) -> list[int]:
        """Entry i: tokens of ``text[:i]``, for i from 0 to len(text)."""
        if self.added is None or "<" not in text:
            return self._plain_prefixes(text)
        out, base, plain = [0], 0, ""
        for k, part in enumerate(self.added.split(text)):
            if k % 2 == 0:
                plain, counts = part, self._plain_prefixes(part)
            else:   # inside a special string the text so far is ordinary
                counts = [0] + [self.total(plain + part[:i]) for i in range(1, len(part))]
                counts.append(self._plain(plain) + 1)
            out += [base + c for c in counts[1:]]
            if k % 2:
                base = out[-1]
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``n_bytes``, ``n_tokens`` and ``over_limit`` per row; null or empty text
    counts nothing.  One row per input row, in any order; only ``key`` and
    ``text`` are read."""
    src = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
    kind = src.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = counter(path).total
        for b in batches:
            texts = [t.as_py() or "" for t in b.column(1)]
            n = np.array([total(t) for t in texts], dtype=np.int64)
            size = np.array([len(t.encode()) for t in texts], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size), pa.array(n), pa.array(n > limit)],
                names=[key, "n_bytes", "n_tokens", "over_limit"])

    return src.mapInArrow(run, f"{key} {kind}, n_bytes long, n_tokens long, over_limit boolean")


def prefix_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``prefix_tokens``: array whose entry i is the exact token count of the
    first i characters (a null text has the one entry 0)."""
    src = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
    kind = src.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = counter(path).prefixes
        for b in small_batches(batches, 1):
            rows = pa.array([prefixes(t.as_py() or "") for t in b.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), rows], names=[key, "prefix_tokens"])

    return src.mapInArrow(run, f"{key} {kind}, prefix_tokens array<int>")


def cut_for_budget(counts: DataFrame, budget: int) -> DataFrame:
    """``cut``: the longest prefix (in characters) with at most ``budget``
    tokens, read from ``prefix_tokens``."""
    fits = F.filter(F.sequence(F.size("prefix_tokens") - 1, F.lit(0)),
                    lambda i: F.get(F.col("prefix_tokens"), i) <= budget)
    return counts.withColumn("cut", F.get(fits, F.lit(0)))


def op6_token_counts(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts(docs, path or public_tokenizers.path("byte_bpe_50k.json"))
