"""Token ids as Parquet files for training.

Every document is one row: its id, its token ids as a list column (dictionary
encoded), how many there are, and how many tokens the same file holds before it
and up to its end (delta encoded).  Rows are in ascending order of doc_id over all files;
the number of a file is in its rows (``part``), and a small side table
(``layout``, one row per file) holds the tokens before each file, so the place
of a document in the whole stream of tokens is known without reading ids.  Row
groups and pages are small and have page indexes, so a range of tokens or some
documents are read from their pages only, and lengths never touch the ids.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from struct import pack
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.llm.shared import Words, small_batches, text_buffer
from tributary.session import scratch_path

END_ID = 1
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
PAGE_ROWS = 1000
# what a Python worker remembers: runs between white space (about 40 bytes each),
# and their parts (about 200 bytes each)
MEMO_RUNS = 1_000_000
MEMO_PARTS = 150_000
_MARKS = ".,;:!?"
# byte-level models see a character for each byte: printable ones as they are,
# the others from 256 on
_UNITS = dict(zip([b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)],
                  range(256, 512), strict=False))
_TOKENS = "part int, doc_id long, before long, after long, n_tokens long, ids array<int>"


class _Ids:
    """Texts to ids by the tokenizers library.  If the tokenizer drops white
    space and joins nothing across it, runs of other characters are encoded
    once and remembered by a 64-bit hash: ids of all runs lie in one array.  Of
    a new run, the letters go without regard to case and the marks at its end
    apart, if the tokenizer does the same."""

    def __init__(self, path: str):
        # one Python worker per core already
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_runs = self._alike("Ab ab  1ab \u00e9.\n\tx", "Ab ab 1ab \u00e9. x".split()) and not any(
            len(t.split()) != 1 for t in added)
        self.by_letters = self._alike("Abc,.", ["abc", ",."]) and self._alike("\u00c9t\u00e9!?", ["\u00e9t\u00e9", "!?"]) \
            and not any(set(t) & set(_MARKS) for t in added)
        # a lower-case word of letters is what the model gets to see of it
        self.model = self.tokenizer.model
        self.by_letters = self.by_letters and all(
            self._word(x) == self._encode([x])[0] for x in ("abc", "the", "\u00e9t\u00e9", "xqzjvk"))
        self._forget()

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_UNITS)
        ids = [t.id for t in self.model.tokenize(word)]
        return pack(f"<{len(ids)}i", *ids)

    def _alike(self, whole: str, parts: list[str]) -> bool:
        return self._encode([whole])[0] == b"".join(self._encode(parts))

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.at, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat, self.used = np.empty(1 << 16, "<i4"), 0
        self.letters: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<i4").tobytes() for e in found]

    def _of_runs(self, runs: list[str]) -> list[bytes]:
        if not self.by_letters:
            return self._encode(runs)
        if len(self.letters) > MEMO_PARTS:
            self.letters.clear()
        letters = self.letters
        out, whole = [], []
        for run in runs:
            core = run.rstrip(_MARKS)
            word = core.lower()
            # lower() knows a final sigma, the tokenizer does not
            if word.isalpha() and core.isalpha() and is_normalized("NFC", word) and "\u03a3" not in core:
                ids = letters.get(word)
                if ids is None:
                    ids = letters[word] = self._word(word)
                if len(core) < len(run):
                    marks = run[len(core):]
                    if marks not in letters:
                        letters[marks] = self._encode([marks])[0]
                    ids += letters[marks]
                out.append(ids)
            else:
                whole.append(len(out))
                out.append(run)
        for i, ids in zip(whole, self._encode([out[i] for i in whole]), strict=True):
            out[i] = ids
        return out

    def _remember(self, keys: np.ndarray, ids: list[bytes]) -> None:
        size = np.array([len(x) // 4 for x in ids], np.int64)
        more = np.frombuffer(b"".join(ids), "<i4")
        need = self.used + len(more)
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat[:self.used], np.empty(max(need, len(self.flat)), "<i4")])
        self.flat[self.used:need] = more
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.at = np.insert(self.at, where, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, where, size)
        self.used = need

    def column(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column and how many each has."""
        if not self.by_runs:
            ids = self._encode([t or "" for t in col.to_pylist()])
            return np.frombuffer(b"".join(ids), "<i4"), np.array([len(x) // 4 for x in ids], np.int64)
        data, offsets = text_buffer(col)
        runs = Words(data, offsets)
        keys, first, which = np.unique(runs.hashes() + (runs.end - runs.start).astype(np.uint64),
                                       return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > MEMO_RUNS:
            self._forget()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        if len(self.keys):
            known = self.keys[np.minimum(place, len(self.keys) - 1)] == keys
        if not known.all():
            new = first[~known]
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(runs.start[new].tolist(), runs.end[new].tolist(), strict=True)]
            self._remember(keys[~known], self._of_runs(texts))
            place = np.searchsorted(self.keys, keys)
        at, size = self.at[place][which], self.size[place][which]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(at - (ends - size), size) + np.arange(total)]
        upto = np.concatenate([[0], ends])[runs.range]
        return ids, np.diff(upto)


@lru_cache(maxsize=2)
def _ids(path: str) -> _Ids:
    return _Ids(path)


def _encoded(path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, before = _ids(path), 0
        for b in small_batches(batches, 2):
            ids, size = encode.column(b.column(2))
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(size), np.int32(end_id))
                size = size + 1
            ends = np.concatenate([[0], np.cumsum(size)])
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(before + ends[:-1]), pa.array(before + ends[1:]),
                 pa.array(size), lists],
                names=["part", "doc_id", "before", "after", "n_tokens", "ids"])
            before += int(ends[-1])

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = END_ID,
                      row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES,
                      page_rows: int = PAGE_ROWS) -> None:
    """Encode ``docs`` (doc_id, text; other columns are not read) and write the
    files ``folder``/tokens and ``folder``/layout.

    A null or empty text has the end id only (no ids at all with ``end_id``
    None).  Rows with a null doc_id come first; rows of one doc_id follow the
    hash of their text, repeated rows follow each other.  An empty table makes
    an empty file.  Ranges of (doc_id, hash, row) are dealt to tasks, so a
    doc_id with many rows is spread too.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ["doc_id", "same", "nth"]
    dealt = (rows.withColumns({"same": F.xxhash64("text"), "nth": F.monotonically_increasing_id()})
             .repartitionByRange(*order).sortWithinPartitions(*order)
             .select(F.spark_partition_id().alias("part"), "doc_id", "text"))
    writer = (dealt.mapInArrow(_encoded(tokenizer, end_id), _TOKENS).write
              .option("compression", "zstd")
              .option("parquet.writer.version", "PARQUET_2_0")      # delta encodings
              .option("parquet.block.size", row_group_bytes)
              .option("parquet.page.size", page_bytes)
              .option("parquet.page.row.count.limit", page_rows)
              .option("parquet.enable.dictionary", "true"))
    for column in ("doc_id", "before", "after", "n_tokens"):                 # sorted or small: deltas
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(f"{folder}/tokens")
    spark = docs.sparkSession
    sizes = (_stored(spark, folder).groupBy("part")
             .agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents"),
                  F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")))
    # one row per file, so one task may order them
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    (sizes.withColumn("base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0).cast("long")))
     .coalesce(1).write.parquet(f"{folder}/layout"))


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_TOKENS).parquet(f"{folder}/tokens")


def layout(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file: part, tokens, documents, first_id, last_id (null ids
    left out) and base, the number of tokens in all files before it."""
    return spark.read.schema("part int, tokens long, documents long, first_id long, last_id long, base long"
                             ).parquet(f"{folder}/layout")


def read_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it) and n_tokens of every
    document; ids are not read."""
    return (_stored(spark, folder).drop("ids").join(layout(spark, folder).select("part", "base"), "part")
            .select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens"))


def read_documents(spark: SparkSession, folder: str, where: Column | None = None) -> DataFrame:
    """doc_id and ids of the documents that fulfil ``where`` (on doc_id or
    n_tokens); the condition reaches row groups and pages."""
    rows = _stored(spark, folder)
    return (rows if where is None else rows.where(where)).select("doc_id", "ids")


def read_token_range(spark: SparkSession, folder: str, start: int, stop: int) -> DataFrame:
    """doc_id, start and ids of the tokens ``start`` to ``stop`` (exclusive) of
    the whole stream, cut at both ends.  Two steps find the pages: the layout
    names the files that take part and the place in the first and last of
    them (two rows on the driver), and these bound ``part``, ``before`` and
    ``after``, which the page indexes know."""
    within = layout(spark, folder).where((F.col("base") < stop) & (F.col("base") + F.col("tokens") > start))
    ends = within.agg(F.min_by(F.struct("part", "base"), "base").alias("first"),
                      F.max_by(F.struct("part", "base"), "base").alias("last")).first()
    rows = _stored(spark, folder)
    if ends["first"] is None or stop <= start:
        return rows.where("false").select("doc_id", F.col("before").alias("start"), "ids")
    part, before = F.col("part"), F.col("before")
    first, last = ends["first"], ends["last"]
    rows = rows.where(part.between(first["part"], last["part"])
                      & ((part < last["part"]) | (before < stop - last["base"]))
                      & ((part > first["part"]) | (F.col("after") > start - first["base"])))
    at = F.col("base") + before
    skip = F.greatest(F.lit(start) - at, F.lit(0)).cast("int")
    upto = F.least(F.lit(stop) - at, F.col("n_tokens")).cast("int")
    return (rows.join(layout(spark, folder).select("part", "base"), "part")
            .where((at < stop) & (at + F.col("n_tokens") > start))
            .select("doc_id", (at + skip).alias("start"), F.slice("ids", skip + 1, upto - skip).alias("ids")))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column(b.schema.get_field_index("ids"))
        values, ends = np.asarray(lists.values, dtype="<i4"), np.asarray(lists.offsets)
        crc = [zlib.crc32(values[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(n) for n in ("part", "doc_id", "before", "n_tokens")), pa.array(crc, pa.int64())],
            names=["part", "doc_id", "before", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (over the ids as little-endian
    32-bit integers) of every document, from the files."""
    rows = _stored(spark, folder).mapInArrow(
        _digest, "part int, doc_id long, before long, n_tokens long, ids_crc32 long")
    return (rows.join(layout(spark, folder).select("part", "base"), "part")
            .select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def op13_token_files(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "token-files")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_token_files(docs, folder, path or public_tokenizers.path("word_bpe_49k.json"))
    return read_digests(spark, folder)
