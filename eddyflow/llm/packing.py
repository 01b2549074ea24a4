"""Packing by non-negative least squares over a histogram of lengths.

Documents are cut into pieces of at most one window.  Lengths are rounded up to
multiples of ``window / BINS`` for planning only; the plan needs nothing but the
histogram (at most ``BINS`` numbers, however many documents there are):

1. enumerate the shallow combinations, one to three bins that fill a window;
2. solve  min ||A x - h||, x >= 0  for their repeat counts (A: bins by
   combinations, h: the histogram);
3. round, never using more pieces of a bin than there are;
4. pack the rest greedily, largest bins first, again on the histogram.

Pieces are numbered within their bin and find their sequence by that number, so
no task or driver sees all pieces.

Defined results: a null or empty text is one piece, its end id; repeated rows are
packed as separate pieces; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, written
from .tokens import slices, vocabulary_path, worker_encoder

WINDOW = 4096
BINS = 256


class Block(NamedTuple):
    """Ranks ``low <= rank < high`` of a bin go to ``repeats`` sequences from
    ``first`` on, one round after the other, in slots from ``slot`` on."""
    bin: int
    low: int
    high: int
    first: int
    repeats: int
    slot: int


def token_pieces(docs: DataFrame, window: int = WINDOW, vocab: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``: each document's ids in
    pieces of at most ``window``."""
    vocab = vocab or vocabulary_path()
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = worker_encoder(vocab), TaskContext.get().partitionId() << 33
        for b, texts in slices(batches, "text"):
            ids, offsets = encoder.encode(texts)
            raw = memoryview(ids.astype("<u4").tobytes())
            n = np.diff(offsets)
            cuts = -(-n // window)
            row = np.repeat(np.arange(len(texts)), cuts)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * window
            length = np.minimum(window, n[row] - start)
            at = offsets[row] + start
            crc = [zlib.crc32(raw[4 * a:4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                 pa.array(n[row]), pa.array(number + np.arange(len(row)))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row"])
            number += len(row)

    return base.mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                          "row bigint")


def combinations(bins: int) -> list[tuple[int, ...]]:
    """One to three bins, ascending, that add up to a full window."""
    out: list[tuple[int, ...]] = [(bins,)]
    out += [(a, bins - a) for a in range(1, bins // 2 + 1)]
    out += [(a, b, bins - a - b) for a in range(1, bins // 3 + 1) for b in range(a, (bins - a) // 2 + 1)]
    return out


def solve_nnls(members: np.ndarray, h: np.ndarray, steps: int = 4000) -> np.ndarray:
    """min ||A x - h||, x >= 0, by projected gradients with momentum that is
    dropped whenever it points uphill.

    ``members`` has the bins of each combination (a row, 0 where it has fewer
    than three): column j of A counts them, bin 0 is no bin.
    """
    def times(x):
        out = np.bincount(members.ravel(), weights=np.repeat(x, members.shape[1]), minlength=len(h))
        out[0] = 0
        return out

    def transposed(r):
        return r[members].sum(axis=1)

    goal = h.astype(float).copy()
    goal[0] = 0
    v = np.ones(len(members))  # the largest eigenvalue of A'A bounds the step
    for _ in range(50):
        w = transposed(times(v))
        size = float(np.linalg.norm(w))
        v = w / size
    x = y = np.zeros(len(members))
    t = 1.0
    for _ in range(steps):
        slope = transposed(times(y) - goal)
        nxt = np.maximum(0.0, y - slope / size)
        if (slope * (nxt - x)).sum() > 0:
            t = 1.0
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = np.maximum(0.0, nxt + (t - 1) / t2 * (nxt - x))
        if np.abs(nxt - x).max() < 1e-7 * max(1.0, float(nxt.max())):
            return nxt
        x, t = nxt, t2
    return x


def plan_packing(histogram: np.ndarray, bins: int = BINS) -> list[Block]:
    """Blocks that place every piece of ``histogram`` (index 1..bins)."""
    left = histogram.astype(np.int64).copy()
    recipes: list[tuple[dict[int, int], int]] = []

    def take(recipe: dict[int, int], repeats: int) -> None:
        if repeats > 0:
            recipes.append((recipe, repeats))
            for b, m in recipe.items():
                left[b] -= m * repeats

    present = np.flatnonzero(left[1:]) + 1
    has = set(present.tolist())
    shallow = [c for c in combinations(bins) if has.issuperset(c)]
    if shallow:
        members = np.array([[*c, *[0] * (3 - len(c))] for c in shallow])
        x = solve_nnls(members, left)
        for j in np.argsort(-x, kind="stable"):
            recipe = {b: shallow[j].count(b) for b in shallow[j]}
            take(recipe, min(int(x[j] + 0.5), *(int(left[b] // m) for b, m in recipe.items())))
    while left.any():
        room, recipe = bins, {}
        for b in (np.flatnonzero(left)[::-1]).tolist():
            if m := min(int(left[b]), room // b):
                recipe[b] = m
                room -= m * b
        take(recipe, min(int(left[b] // m) for b, m in recipe.items()))

    blocks, first = [], 0
    used = np.zeros(len(left), np.int64)
    for recipe, repeats in recipes:
        slot = 0
        for b, m in sorted(recipe.items(), reverse=True):
            low = int(used[b])
            used[b] += m * repeats
            blocks.append(Block(b, low, low + m * repeats, first, repeats, slot))
            slot += m
        first += repeats
    return blocks


def pack_pieces(pieces: DataFrame, window: int = WINDOW, bins: int = BINS) -> DataFrame:
    """``pieces`` (read from storage, as two jobs use them) with ``sequence_id``
    and ``offset``."""
    spark = pieces.sparkSession
    binned = pieces.withColumn("_bin", F.ceil(F.col("length") * bins / window).cast("int"))
    histogram = np.zeros(bins + 1, np.int64)
    for r in binned.groupBy("_bin").count().collect():  # at most `bins` rows
        histogram[r["_bin"]] = r["count"]
    plan = spark.createDataFrame(
        plan_packing(histogram, bins) or [Block(0, 0, 0, 0, 1, 0)],
        "b_bin int, low bigint, high bigint, first bigint, repeats bigint, slot bigint")
    ranked = numbered(binned, ["_bin"], ["row"], "_rank", F.xxhash64("row"))  # rows of one id are dealt too
    # The plan's size is bounded by the number of bins, not by the pieces.
    placed = ranked.join(F.broadcast(plan), (F.col("_bin") == F.col("b_bin")) & (F.col("_rank") >= F.col("low"))
                         & (F.col("_rank") < F.col("high")))
    seat = F.col("_rank") - F.col("low")
    placed = (placed.withColumn("sequence_id", F.col("first") + seat % F.col("repeats"))
              .withColumn("_slot", F.col("slot") + F.expr("(_rank - low) div repeats")))
    before = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, window: int = WINDOW, bins: int = BINS, **kwargs) -> DataFrame:
    return pack_pieces(written(token_pieces(docs, window, **kwargs), "pieces"), window, bins)
