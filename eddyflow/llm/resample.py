"""Importance resampling of documents towards a target distribution.

Features are runs of consecutive words, hashed by CRC-32 into buckets.  Each run
of texts gets an Aho-Corasick automaton over its distinct words, each bounded by
delimiters on both sides, so that every word of a text matches exactly one
pattern.  A pattern carries the word's CRC-32 and length as its payload; a scan
emits payloads in the order of the text, and the CRC of a longer run follows
from its neighbours' payloads alone (the CRC of ``ab`` is that of ``a`` moved by
the length of ``b``, plus that of ``b``), without looking at the text again.

The buckets of every document are written once (two bytes a feature); corpus
counts, and after them the scores, come from that table.  A bucket's gain
compares its smoothed shares of the target's and the corpus' features; a
document's score is the sum of its features' gains plus Gumbel noise that depends
on its id alone, and the highest scores are drawn: a sample without replacement.

Defined results: a null or empty text has no features and weight 0; texts of
any length are cut at delimiters and scanned in pieces; words over ``LONG_WORD``
bytes are given their payload where they stand, without a pattern; a null id has
the noise of the empty string and loses ties; repeated rows are drawn each by
itself; an empty table gives an empty result, an empty target equal shares;
extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import with_global_position
from .common import written
from .tokens import pieces, slices

BUCKETS = 10_000
MAX_RUN = 1
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
SLICE_BYTES = 8 << 20
LONG_WORD = 64

_POLYNOMIAL = 0xEDB88320  # CRC-32, bits reversed


def _fold_table() -> bytes:
    """A-Z lowered; digits, letters and bytes beyond ASCII stay; the rest is a delimiter."""
    chars = bytearray(b" " * 256)
    for b in range(256):
        if b >= 0x80 or chr(b).isalnum():
            chars[b] = b + 32 if 0x41 <= b <= 0x5A else b
    return bytes(chars)


FOLD = _fold_table()


class CrcShift:
    """``shift(crc, n)``: the CRC register after ``n`` zero bytes, a linear map
    over its 32 bits; one matrix per length, kept as 32 columns."""

    def __init__(self):
        bit = np.array([1 << k for k in range(32)], dtype=np.uint32)
        for _ in range(8):
            bit = (bit >> 1) ^ np.where(bit & 1, np.uint32(_POLYNOMIAL), np.uint32(0))
        self.powers = [bit]  # 1, 2, 4, ... bytes
        self.known: dict[int, np.ndarray] = {}

    @staticmethod
    def apply(columns: np.ndarray, crc: np.ndarray) -> np.ndarray:
        out = np.zeros(len(crc), dtype=np.uint32)
        for k in range(32):
            out ^= np.where((crc >> np.uint32(k)) & 1, columns[..., k], np.uint32(0)).astype(np.uint32)
        return out

    def columns(self, n: int) -> np.ndarray:
        if n not in self.known:
            out, level, left = np.array([1 << k for k in range(32)], dtype=np.uint32), 0, n
            while left:
                if level == len(self.powers):
                    self.powers.append(self.apply(self.powers[-1], self.powers[-1]))
                if left & 1:
                    out = self.apply(self.powers[level], out)
                left, level = left >> 1, level + 1
            self.known[n] = out
        return self.known[n]

    def __call__(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        sizes, which = np.unique(lengths, return_inverse=True)
        return self.apply(np.stack([self.columns(int(n)) for n in sizes])[which], crc) if len(crc) else crc


class WordDictionary:
    """Payloads of the words of a run of texts, by one automaton."""

    def __init__(self, texts: list[bytes]):
        import ahocorasick
        words = {w for t in texts for w in t.split(b" ")}
        words.discard(b"")
        self.long = any(len(w) > LONG_WORD for w in words)
        self.automaton = ahocorasick.Automaton()
        for w in words:
            if len(w) <= LONG_WORD:
                # Bytes as code points: patterns and texts are matched byte by byte.
                self.automaton.add_word(f" {w.decode('latin-1')} ", len(w) << 32 | zlib.crc32(w))
        self.empty = not len(self.automaton)
        self.automaton.make_automaton()

    def payloads(self, text: bytes) -> np.ndarray:
        """(length << 32 | CRC) of the words of one folded text, in order."""
        shown = f" {text.decode('latin-1')} "
        if not self.long:
            return np.fromiter((p for _, p in self.automaton.iter(shown)), np.int64) if not self.empty \
                else np.empty(0, np.int64)
        found = [] if self.empty else list(self.automaton.iter(shown))
        for m in re.finditer(rb"[^ ]{%d,}" % (LONG_WORD + 1), text):
            found.append((m.end() + 1, len(m[0]) << 32 | zlib.crc32(m[0])))
        return np.array([p for _, p in sorted(found)], dtype=np.int64)


def run_crcs(payloads: np.ndarray, max_run: int, shift: CrcShift) -> np.ndarray:
    """CRCs of all runs of 1 to ``max_run`` words, joined by one space."""
    lengths, crcs = payloads >> 32, (payloads & 0xFFFFFFFF).astype(np.uint32)
    out, run = [crcs], crcs
    space, one = np.uint32(zlib.crc32(b" ")), shift.columns(1)
    for n in range(1, max_run):
        if len(crcs) <= n:
            break
        spaced = shift.apply(one, run[:-1]) ^ space
        run = shift(spaced, lengths[n:]) ^ crcs[n:]
        out.append(run)
    return np.concatenate(out)


def bucketed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_run: int = MAX_RUN,
             buckets: int = BUCKETS) -> DataFrame:
    """``id, row, n_words, n_features, buckets`` (the buckets as little-endian
    integers); ``row`` tells rows apart and is fixed once the table is written."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["id"].dataType.simpleString()
    form = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, row = CrcShift(), TaskContext.get().partitionId() << 33
        for b, texts in slices(batches, "text", SLICE_BYTES):
            folded = [t.translate(FOLD) for t in texts]
            words = WordDictionary(folded)
            n_words, found = [], []
            for t in folded:
                emitted = [words.payloads(p) for p in pieces(t)]
                payloads = np.concatenate(emitted) if len(emitted) > 1 else emitted[0]
                n_words.append(len(payloads))
                found.append((run_crcs(payloads, max_run, shift) % buckets).astype(form))
            yield pa.RecordBatch.from_arrays([
                b.column("id"), pa.array(np.arange(row, row + len(texts))), pa.array(n_words, pa.int64()),
                pa.array([len(f) for f in found], pa.int64()), pa.array([f.tobytes() for f in found], pa.binary())],
                names=["id", "row", "n_words", "n_features", "buckets"])
            row += len(texts)

    return base.mapInArrow(run, f"id {kind}, row bigint, n_words bigint, n_features bigint, buckets binary")


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket: summed in each task, then over tasks; at most
    ``buckets`` rows reach the driver."""
    form = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for blob in b.column("buckets"):
                total += np.bincount(np.frombuffer(blob.as_buffer(), form), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for r in features.select("buckets").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(
            F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: 1000 x the log of its share in the target over that in the
    corpus, each smoothed by one feature a bucket, rounded down."""
    b = len(corpus)
    s_all, t_all = float(corpus.sum() + b), float(target.sum() + b)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
                     for s, t in zip(corpus, target)], dtype=np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``id, row, n_words, n_features, weight``: the sum of the features' gains."""
    form = "<u2" if len(gain) <= 1 << 16 else "<u4"
    kind = features.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weight = [int(gain[np.frombuffer(blob.as_buffer(), form)].sum()) for blob in b.column("buckets")]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("id", "row", "n_words", "n_features")]
                                             + [pa.array(weight, pa.int64())],
                                             names=["id", "row", "n_words", "n_features", "weight"])

    return features.mapInArrow(run, f"id {kind}, row bigint, n_words bigint, n_features bigint, weight bigint")


def noise(id_col, seed: str = SEED):
    """Gumbel noise x 1000 of an id, rounded down."""
    shown = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(shown, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", max_run: int = MAX_RUN, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """Every document's ``id, n_features, weight, score, rank``; ``rank`` numbers
    the drawn documents (``percent`` of those with ``min_words``), else null."""
    features = written(bucketed(docs, id_col, text_col, max_run, buckets), "features")
    wanted = bucketed(target.select(F.lit(0).alias("id"), F.col(target_text_col).alias("text")),
                      "id", "text", max_run, buckets)
    gain = gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets))
    drawn = features.where(F.col("n_words") >= min_words).count() * percent // 100
    scored = weighed(features, gain).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    ranked = with_global_position(scored.where(F.col("n_words") >= min_words), [
        F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row")], "rank")
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(rest).select(
        F.col("id").alias(id_col), "n_features", "weight", "score", F.col("rank").cast("bigint").alias("rank"))
