"""Language identification by rank-order profiles of n-grams.

A profile is the list of the ``PROFILE`` most frequent n-grams (one to three
letters, with word edges) of a language's training texts, counted over all of
them.  A document's own most frequent ``DOCUMENT`` n-grams are compared with
each profile by the out-of-place distance: the sum of the differences of ranks,
``PROFILE`` for an n-gram that the profile lacks.  The nearest language wins;
the score is 1 - distance / largest possible distance.

Defined results: a null text or one without letters is ``und`` with score 0, as
is every text when there is nothing to learn from; a null id counts as the empty
string when folds are dealt; equal distances go to the smaller language name;
n-grams of equal frequency rank by code points; rows are judged one by one, so
repeated rows agree; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of
from .tokens import slices

PROFILE = 400
DOCUMENT = 300
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
MIN_SCORE = 0.05
PIECE = 1 << 20


def held_out(id_col: str = "doc_id", folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Keys (code points, 21 bits each) and counts of the n-grams of the words
    of letters; keys ascending."""
    letters = re.sub(r"[\W\d_]+", " ", (text or "").lower())
    if not any(map(str.isalpha, letters)):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = [_piece_counts(f" {p} ") for p in _pieces(letters.strip())]
    return found[0] if len(found) == 1 else fold_counts(found)


def _pieces(letters: str) -> Iterator[str]:
    """Long texts in runs of about ``PIECE`` characters, cut between words."""
    at = 0
    while len(letters) - at > PIECE and (cut := letters.find(" ", at + PIECE)) >= 0:
        yield letters[at:cut]
        at = cut + 1
    yield letters[at:] if at else letters


def _piece_counts(words: str) -> tuple[np.ndarray, np.ndarray]:
    a = np.frombuffer(words.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    gap = a == 32
    two = (a[:-1] << np.uint64(21)) | a[1:]
    three = (two[:-1] << np.uint64(21)) | a[2:]
    grams = np.concatenate([a[~gap], two[~(gap[:-1] & gap[1:])], three[~gap[1:-1]]])
    return np.unique(grams, return_counts=True)


def fold_counts(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """Counts of several texts in one."""
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, weights=np.concatenate([c for _, c in parts])).astype(np.int64)


def training_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, gram, n`` over all rows of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        for b, texts in slices(batches, "text"):
            for lang, text in zip(b.column("lang").to_pylist(), texts):
                parts = held.setdefault(lang, [])
                parts.append(gram_counts(text.decode()))
                if len(parts) > 500:
                    held[lang] = [fold_counts(parts)]
        for lang, parts in held.items():
            keys, counts = fold_counts(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)),
                                              pa.array(counts)], names=["lang", "gram", "n"])

    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"),
                                                          F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))


def language_profiles(docs: DataFrame, size: int = PROFILE, lang_col: str = "lang",
                      text_col: str = "text") -> DataFrame:
    """``lang, gram, rank`` of the ``size`` most frequent n-grams."""
    by = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    # A filter on the row number itself keeps `size` rows a language and task before the shuffle.
    return (training_counts(docs, lang_col, text_col).withColumn("place", F.row_number().over(by))
            .where(F.col("place") <= size).select("lang", "gram", (F.col("place") - 1).alias("rank")))


def predict_languages(docs: DataFrame, profiles: DataFrame, size: int = PROFILE, top: int = DOCUMENT,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, held_out, lang_pred, score`` per row."""
    ranked = profiles.collect()  # `size` rows per language
    langs = sorted({r["lang"] for r in ranked})
    grams = np.array(sorted({r["gram"] for r in ranked}), dtype=np.int64).view(np.uint64)
    ranks = np.full((len(grams) + 1, len(langs)), -1, np.int32)  # last row: in no profile
    for r in ranked:
        ranks[np.searchsorted(grams, np.uint64(r["gram"])), langs.index(r["lang"])] = r["rank"]

    def judge(text):
        keys, counts = gram_counts(text)
        if not len(keys) or not langs:
            return UNKNOWN, 0.0
        keys = keys[np.argsort(-counts, kind="stable")[:top]]
        at = np.minimum(np.searchsorted(grams, keys), len(grams) - 1)
        theirs = ranks[np.where(grams[at] == keys, at, len(grams))]
        apart = np.where(theirs < 0, size, np.abs(theirs - np.arange(len(keys))[:, None])).sum(axis=0)
        best = int(np.argmin(apart))
        return langs[best], 1.0 - float(apart[best]) / (len(keys) * size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in slices(batches, "text"):
            found = [judge(t.decode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), b.column("held_out"),
                 pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "text_hash", "held_out", "lang_pred", "score"])

    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
                       held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {kind}, text_hash bigint, held_out boolean, lang_pred string, score double")


def judge_languages(docs: DataFrame, size: int = PROFILE, top: int = DOCUMENT) -> DataFrame:
    """Learn from the documents outside the held-out fold, judge all; ``doc_id``
    and ``text_hash`` are the key of a row."""
    return predict_languages(docs, language_profiles(docs.where(~held_out()), size), size, top)


def identify(docs: DataFrame, **kwargs) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row."""
    return judge_languages(docs, **kwargs).drop("text_hash")


def keep_known(docs: DataFrame, min_score: float = MIN_SCORE, **kwargs) -> DataFrame:
    """The rows of ``docs`` whose language is known, with all their columns."""
    bad = judge_languages(docs, **kwargs).where((F.col("lang_pred") == UNKNOWN) | (F.col("score") < min_score))
    keys = bad.select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_text")).distinct()
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys["_bad_id"])
                     & (F.xxhash64(text_of()) == keys["_bad_text"]), "left_anti")
