"""BPE encoding and decoding.

Encoding: an Aho-Corasick automaton over the vocabulary finds the longest token
at every position; tokens are taken greedily, a token is accepted only if it
fits its left neighbour (``MergeTable.fits``), otherwise the next shorter token
is tried, and positions that cannot be continued are left for good.  Every
position is given up at most once, so a word costs linear time, and the result
equals replaying the merges.  Decoding copies token texts from one buffer by an
offset table.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.bpe_tables import SPAN, MergeTable, Remembered, merge_table
from tributary.llm.shared import extended, small_batches

# Fixed value: how the vocabulary's tokenizer splits normalised text into words.
WORD_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]"
                r"|[^\p{White_Space}\p{L}\p{N}]+")
# new entries after which a Python worker forgets (about 200 bytes each)
CACHE_WORDS = 60_000
CACHE_RUNS = 150_000
# where a job does nothing else in its workers
ALONE_WORDS = 200_000
ALONE_RUNS = 500_000
_SEPARATORS = re.compile("[\x1c-\x1f]")


def encode_units(table: MergeTable, units: str) -> list[int]:
    """Token ids of one word, by backtracking over longest matches."""
    n = len(units)
    longest: list[int | None] = [None] * (n + 1)
    size = [0] * n
    for end, (token, length) in table.automaton.iter(units):
        start = end - length + 1
        if length > size[start]:
            size[start], longest[start] = length, token
    if n and size[0] == n:
        return [longest[0]]
    known, shorter, length_of = table.known, table.shorter, table.length
    dead = set()
    taken: list[int] = []
    at, token = 0, longest[0]
    while at < n:
        if token is None:            # nothing fits here: step back
            dead.add(at)
            token = taken.pop()
            at -= length_of[token]
            token = shorter[token]
            continue
        end = at + length_of[token]
        if end not in dead:
            if taken:
                left = taken[-1]
                fit = known.get(left * SPAN + token)
                if fit is None:
                    fit = table.fits(left, token)
            else:
                fit = True
            if fit:
                taken.append(token)
                at, token = end, longest[end]
                continue
        token = shorter[token]
    return taken


class Encoder:
    """Text to ids and back, for a vocabulary with word ends."""

    def __init__(self, path: str, words: int = CACHE_WORDS, runs: int = CACHE_RUNS):
        self.table = merge_table(path)
        self.find = regex.compile(WORD_PATTERN).findall
        self.words = Remembered(self._word, words)
        self.runs = Remembered(self._run, runs)
        added = sorted(self.table.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        texts = self.table.token_text
        last = max(texts, default=-1)
        raw = [(texts.get(i, "") + " ").encode() for i in range(last + 1)]
        self.buffer = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.offsets = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum([len(r) for r in raw], out=self.offsets[1:])

    def _word(self, word: str) -> bytes:
        return np.array(encode_units(self.table, self.table.units(word.encode())), "<u4").tobytes()

    def _run(self, run: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.find(run)))

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        # no word holds white space, so runs between it are looked up whole;
        # four control characters are white space to split() only
        if _SEPARATORS.search(text):
            return self._run(text)
        return b"".join(map(self.runs.__getitem__, text.split()))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.added is None or "<" not in text:
            return self._plain(text)
        out = []
        for k, part in enumerate(self.added.split(text)):
            if k % 2:
                out.append(np.uint32(self.table.added[part]).tobytes())
            elif part:
                out.append(self._plain(part))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """Token texts joined by one space, gathered through the offset table."""
        if len(ids) == 0:
            return b""
        ids = ids.astype(np.int64)
        size = self.offsets[ids + 1] - self.offsets[ids]
        begin = np.cumsum(size) - size
        take = np.repeat(self.offsets[ids] - begin, size) + np.arange(int(size.sum()))
        return self.buffer[take].tobytes()[:-1]


@lru_cache(maxsize=2)
def encoder(path: str, words: int = CACHE_WORDS, runs: int = CACHE_RUNS) -> Encoder:
    return Encoder(path, words, runs)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (array of int) and ``n_tokens`` added; a null
    or empty text has no tokens.  Existing columns of these names are replaced;
    every other column, null keys and repeated rows pass through unchanged."""
    src = docs.drop("token_ids", "n_tokens")
    names = src.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in small_batches(batches, at):
            raw = [enc.encode(t.as_py() or "") for t in b.column(at)]
            size = np.array([len(r) // 4 for r in raw], dtype=np.int64)
            ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(raw), dtype="<u4").astype(np.int32))
            ids = pa.ListArray.from_arrays(pa.array(ends), flat)
            yield pa.RecordBatch.from_arrays([*b.columns, ids, pa.array(size)],
                                             names=[*names, "token_ids", "n_tokens"])

    out = extended(src, token_ids="array<int>", n_tokens="long")
    return src.mapInArrow(run, out)


def decode(encoded: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """``encoded`` with ``decoded`` (string) added; a null or empty list of ids
    decodes to the empty text."""
    src = encoded.drop("decoded")
    names = src.columns
    at = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            col = b.column(at)
            text = [enc.decode(np.asarray(x.values)) if x.is_valid else b"" for x in col]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(text, pa.binary()).cast(pa.string())],
                names=[*names, "decoded"])

    return src.mapInArrow(run, extended(src, decoded="string"))


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
            words: int = ALONE_WORDS, runs: int = ALONE_RUNS) -> DataFrame:
    """Encode and decode in one pass over the texts; only lengths and SHA-256
    digests leave the task.  ``words`` and ``runs``: entries that a worker
    remembers."""
    src = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
    kind = src.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, words, runs)
        for b in batches:
            n, ids, back = [], [], []
            for t in b.column(1):
                raw = enc.encode(t.as_py() or "")
                n.append(len(raw) // 4)
                ids.append(hashlib.sha256(raw).hexdigest())
                back.append(hashlib.sha256(enc.decode(np.frombuffer(raw, "<u4"))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                 pa.array(back, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return src.mapInArrow(run, f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, path or public_tokenizers.path("word_bpe_49k.json"))
