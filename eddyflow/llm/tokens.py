"""Token ids as Parquet list columns.

Encoding: the tokenizer drops white space and no token spans it, so the ids of a
text are those of its white-space separated words, one after the other.  Each
worker process encodes every distinct word once with the tokenizers library and
puts texts together from those ids; the store of words outlives a task and is
emptied when it is full, which changes nothing but speed.

Files: one row per document in ascending ``doc_id`` order, columns ``doc_id,
part, part_start, n_tokens, tokens``; row groups and pages of set size,
dictionary encoding for the ids (delta encoding where a dictionary overflows,
format version 2) and page indexes, so a reader of a few documents or of the
metadata columns alone touches only their pages.

Defined results: a null or empty text has the end id alone; null ``doc_id`` sorts
first; rows of one id follow one another in the table's order; repeated rows are
kept; very long texts are encoded in pieces; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_path

END_ID = 2
WORD_END = "</w>"  # the vocabulary's mark of a token that ends a word
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII punctuation
# Kinds of bytes: 1 a letter, 2 a mark, 8 part of a character beyond ASCII, 4 another.
_KIND = np.array([8 if b >= 0x80 else 1 if chr(b).isalpha() else 2 if chr(b) in MARKS else 4 for b in range(256)], np.uint8)
_LETTERS_MARKS = re.compile(rb"(?m)^([^\n%s]+)([%s]+)$" % ((re.escape(MARKS.encode()),) * 2))
SLICE_BYTES = 2 << 20
PIECE_BYTES = 1 << 20
CACHE_WORDS = 3 << 18
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class _Codes(dict):
    """word -> code; unknown words get the next code and are noted."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self) + 1  # code 0 is the end of a document
        self.new.append(word)
        return code


class WordEncoder:
    """Token ids of texts by way of their distinct words.

    A-Z are lowered beforehand, as the tokenizer does.  A word of letters in
    normal form, lower case, with or without ASCII marks after it, and a word
    of marks are one or two units to the tokenizer, whatever stands around.  Many such
    words go through the same merges in one call, without the steps that would
    leave them as they are, and are told apart by the tokens that end a unit.
    """

    def __init__(self, path: str, end_id: int = END_ID, cache_words: int = CACHE_WORDS):
        import json
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        parts = json.loads(self.tokenizer.to_str()) | {"normalizer": None, "added_tokens": []}
        self.merges = Tokenizer.from_str(json.dumps(parts))
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.end_id, self.cache_words = end_id, cache_words
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocab.items() if token.endswith(WORD_END)]] = True
        self._clear()

    def _clear(self) -> None:
        self.codes = _Codes()
        self.flat = np.array([self.end_id], dtype=np.uint32)
        self.starts = np.array([0], dtype=np.int64)
        self.lens = np.array([1], dtype=np.int64)

    def _plain(self, words: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """Units of each word that is letters, marks, or letters and then marks;
        0 for other words (and those with letters beyond ASCII: listed apart)."""
        flat = _KIND[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum([len(w) for w in words])
        starts = np.concatenate([[0], ends[:-1]])
        kinds = np.bitwise_or.reduceat(flat, starts)
        # A letter that follows a mark inside a word.
        back = np.zeros(len(flat) + 1, np.int64)
        back[2:] = np.cumsum((flat[1:] == 1) & (flat[:-1] == 2)) if len(flat) > 1 else 0
        inner = back[ends] - back[starts + 1]
        units = np.where((kinds <= 3) & (inner == 0), np.where(kinds == 3, 2, 1), 0)
        return units, np.flatnonzero((kinds & 8) > 0).tolist()

    def _learn(self) -> None:
        """Ids of the words noted as new."""
        raw, self.codes.new = self.codes.new, []
        units, beyond = self._plain(raw)
        words: dict[int, str] = {}
        for i in beyond:
            w = words[i] = raw[i].decode("utf-8", "replace")
            stem = w.rstrip(MARKS)
            if stem.isalpha() and is_normalized("NFC", stem) and stem == stem.lower():
                units[i] = 2 if len(stem) < len(w) else 1
        starts, lens = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
        flat, size = [self.flat], len(self.flat)
        plain = np.flatnonzero(units)
        # Letters and the marks after them are shown apart.
        text = b"\n".join([raw[i] for i in plain.tolist()])
        shown = _LETTERS_MARKS.sub(rb"\1 \2", text).decode("utf-8").split("\n") if len(plain) else []
        runs = [slice(i, i + 64) for i in range(0, len(plain), 64)]
        for run, e in zip(runs, self.merges.encode_batch_fast([" ".join(shown[r]) for r in runs], add_special_tokens=False)):
            ids = np.array(e.ids, dtype=np.uint32)
            ends = (np.flatnonzero(self.ends_word[ids]) + 1)[np.cumsum(units[plain[run]]) - 1]
            starts[plain[run]] = size + np.concatenate([[0], ends[:-1]])
            lens[plain[run]] = np.diff(ends, prepend=0)
            flat.append(ids)
            size += len(ids)
        single = np.flatnonzero(units == 0).tolist()
        alone = [words.get(i) or raw[i].decode("utf-8", "replace") for i in single]
        for i, e in zip(single, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            ids = np.array(e.ids, dtype=np.uint32)
            starts[i], lens[i] = size, len(ids)
            flat.append(ids)
            size += len(ids)
        self.flat = np.concatenate(flat)
        self.starts = np.concatenate([self.starts, starts])
        self.lens = np.concatenate([self.lens, lens])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, end id included; offsets)."""
        if len(self.codes) > self.cache_words:
            self._clear()
        codes: list[int] = []
        counts = np.empty(len(texts), np.int64)
        look_up = self.codes.__getitem__
        for i, t in enumerate(texts):
            before = len(codes)
            for piece in pieces(t):
                codes.extend(map(look_up, piece.lower().split()))
            codes.append(0)
            counts[i] = len(codes) - before
        if self.codes.new:
            self._learn()
        all_codes = np.fromiter(codes, np.int64, len(codes))
        lens = self.lens[all_codes]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        where = np.repeat(self.starts[all_codes] - (ends - lens), lens)
        where += np.arange(total)
        offsets = np.zeros(len(texts) + 1, np.int64)
        offsets[1:] = ends[np.cumsum(counts) - 1] if len(texts) else 0
        return self.flat[where], offsets


def worker_encoder(path: str) -> WordEncoder:
    """The encoder of this worker process: tasks that run one after the other in
    it go on with the words it knows."""
    kept = sys.modules.setdefault("_eddyflow_worker", types.ModuleType("_eddyflow_worker")).__dict__
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """A text in runs of about ``size`` bytes, cut at white space."""
    at = 0
    while len(text) - at > size:
        cut = re.compile(rb"[ \t-\r]").search(text, at + size)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE_BYTES):
    """(other columns' batch, texts as bytes) in runs of about ``size`` bytes."""
    for b in batches:
        col = b.column(text).cast(pa.large_binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy())
        i = 0
        while i < b.num_rows:
            base = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, base + size, "right")))
            yield b.slice(i, j - i), [x or b"" for x in col.slice(i, j - i).to_pylist()]
            i = j


def encode_documents(docs: DataFrame, vocab: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                     partitions: int | None = None) -> DataFrame:
    """``doc_id, part, part_start, n_tokens, tokens``, sorted by ``doc_id`` within
    parts and parts ascending."""
    vocab = vocab or vocabulary_path()
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    kind = base.schema["doc_id"].dataType.simpleString()
    # The row's place deals rows of one id (or of none) over as many parts as they fill.
    order = base.repartitionByRange(*([partitions] if partitions else []), "doc_id", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = worker_encoder(vocab), TaskContext.get().partitionId(), 0
        for b, texts in slices(batches, "text"):
            ids, offsets = encoder.encode(texts)
            n = np.diff(offsets)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(np.full(len(texts), part, np.int32)), pa.array(before + offsets[:-1]),
                pa.array(n), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)),
                                                      pa.array(ids.astype(np.int32)))],
                names=["doc_id", "part", "part_start", "n_tokens", "tokens"])
            before += int(offsets[-1])

    return order.sortWithinPartitions("doc_id", "row").drop("row").mapInArrow(
        run, f"doc_id {kind}, part int, part_start bigint, n_tokens bigint, tokens array<int>")


def write_tokens(docs: DataFrame, path: str, **kwargs) -> None:
    (encode_documents(docs, **kwargs).write
     .option("compression", "zstd")
     .option("parquet.writer.version", "v2")
     .option("parquet.enable.dictionary", "true")
     .option("parquet.block.size", str(ROW_GROUP_BYTES))
     .option("parquet.page.size", str(PAGE_BYTES))
     .option("parquet.page.row.count.limit", str(PAGE_ROWS))
     .parquet(path))


def part_bases(files: DataFrame) -> DataFrame:
    """``part, base``: ids in the parts before it; one row per part, from the
    metadata columns alone."""
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(F.col("part").alias("b_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def ids_crc32(tokens: pa.ListArray) -> list[int]:
    """Unsigned CRC-32 of each row's ids as little-endian 32-bit integers."""
    offsets = tokens.offsets.to_numpy()
    ids = memoryview(tokens.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes())
    return [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(offsets[:-1], offsets[1:])]


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read back from the files."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), b.column("part_start"), b.column("n_tokens"),
                 pa.array(ids_crc32(b.column("tokens")), pa.int64())],
                names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    rows = files.mapInArrow(run, f"doc_id {kind}, part int, part_start bigint, n_tokens bigint, ids_crc32 bigint")
    return (rows.join(part_bases(files), F.col("part") == F.col("b_part"))
            .select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"))


def tokenised(docs: DataFrame, **kwargs) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder; their index."""
    spark = docs.sparkSession
    path = shared_path(spark, "tokens")
    write_tokens(docs, path, **kwargs)
    return token_index(spark, path)
