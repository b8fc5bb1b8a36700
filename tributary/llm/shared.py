"""Helpers shared by the operators of this subpackage: hand-over tables in the
shared folder, and vectorised word hashing over Arrow text buffers."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tributary.session import scratch_path

# words are runs of bytes other than space, tab, \n, \v, \f, \r
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# or, for words that are letters and digits only, of any other ASCII byte too
_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[48:58] = _BETWEEN[65:91] = _BETWEEN[97:123] = _BETWEEN[128:] = False

# One documented random source: all hashes are the same in every task.
_RNG = np.random.Generator(np.random.PCG64(20240917))
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)
_POW = np.ones(1, dtype=np.uint64)
_INV = np.ones(1, dtype=np.uint64)
CHUNK_BYTES = 1 << 20


def importable(spark: SparkSession) -> None:
    """Let the session's Python workers import this package from where the
    driver did (on a cluster: the same path, or the package installed)."""
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def lean_workers(spark: SparkSession) -> None:
    """``importable``, and workers that hand freed Arrow memory back to the
    system at once: for jobs whose Python stages share workers, so that one
    stage's unused memory does not stay beside the next one's."""
    importable(spark)
    spark.sparkContext.environment.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read back:
    cuts the lineage, survives lost executors, keeps column pruning, and gives
    later joins a known size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def extended(df: DataFrame, **kinds: str) -> StructType:
    """The schema of ``df`` with more columns after its own."""
    more = StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in kinds.items()))
    return StructType([*df.schema.fields, *more.fields])


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads the bits of 64-bit hashes (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> None:
    global _POW, _INV
    have = len(_POW)
    if n <= have:
        return
    n = max(n, CHUNK_BYTES + 1)
    step = np.full(n - 1, np.uint64(_BASE))
    back = np.full(n - 1, np.uint64(_BASE_INV))
    _POW = np.concatenate([np.ones(1, np.uint64), np.cumprod(step, dtype=np.uint64)])
    _INV = np.concatenate([np.ones(1, np.uint64), np.cumprod(back, dtype=np.uint64)])


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 document offsets into
    them; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type):
        return np.empty(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    _, offs, data = col.buffers()
    if offs is None or len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(offs, np.int64, len(col) + 1, col.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def doc_chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about CHUNK_BYTES together; a longer document
    makes a range of its own, whole."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def small_batches(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about CHUNK_BYTES of text, so that what is
    made of a batch stays small; a longer text is a batch of its own, whole."""
    for b in batches:
        _, offsets = text_buffer(b.column(column))
        for i, j in doc_chunks(offsets):
            yield b.slice(i, j - i)


class Words:
    """The words of some documents: spans, 64-bit hashes and word ranges."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False,
                 letters: bool = False):
        self.data, self.offsets = data, offsets
        n = len(data)
        word = ~(_BETWEEN if letters else _SPACE)[data]
        start, end = word.copy(), word.copy()
        if n:
            inner = offsets[(offsets > 0) & (offsets < n)]
            start[1:] &= ~word[:-1]
            end[:-1] &= ~word[1:]
            start[inner] = word[inner]
            end[inner - 1] = word[inner - 1]
        self.word = word
        self.start = np.flatnonzero(start)
        self.end = np.flatnonzero(end) + 1
        self.range = np.searchsorted(self.start, offsets)
        _powers(n + 1)
        table = _BYTE_LOWER if lower else _BYTE
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(table[data] * _POW[:n], out=self.sums[1:])

    def hashes(self) -> np.ndarray:
        return mix64((self.sums[self.end] - self.sums[self.start]) * _INV[self.start])

    def prefix_hashes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the first ``size`` bytes of each longer word; its index."""
        at = np.flatnonzero(self.end - self.start > size)
        s = self.start[at]
        return mix64((self.sums[s + size] - self.sums[s]) * _INV[s] + np.uint64(size)), at


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words (of all words, if there are fewer)."""
    k = min(k, len(words))
    if k == 0:
        return np.empty(0, dtype=np.uint64)
    n = len(words) - k + 1
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out = (out + words[j:j + n]) * np.uint64(0xD1342543DE82EF95)
    return mix64(out + np.uint64(k))
