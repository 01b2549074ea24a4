"""SimHash near-duplicates through a byte-position inverted index.

Fingerprints at most ``max_bits`` = 3 bits apart differ in at most three of their
eight bytes, so they share at least five bytes at the same positions: the
guaranteed minimum.  A posting list per single byte position would hold one in
256 fingerprints; instead the index is keyed by three positional bytes within a
half of the fingerprint (eight keys).  Five shared bytes put three into one
half, so every pair in question meets under some key.  There the shared
positional bytes of a pair are tallied, pairs under the minimum are dropped,
and the rest is verified bit by bit.

Equal fingerprints are one node.  Posting lists over ``HOT`` fingerprints are
keyed anew by five positional bytes; these hold at most 2^24 fingerprints, and a
list gives a spanning forest of its links (one link per fingerprint at most),
not all pairs.  Lists over ``DENSE`` fingerprints are linked by spreading the
smallest label over the cube of their 24 free bits: the same links in time and
memory that do not depend on their length.

Defined results: a null, empty or wordless text has fingerprint 0 and is linked
like any other; repeated rows share fingerprint and component; rows with a null
id get the component of their fingerprint; the component of a group without any
id is null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of, written
from .components import components
from .tokens import pieces, slices

SHINGLE = 3
MAX_BITS = 3
SEED = 42
HOT = 1024
DENSE = 16384


def simhash(text: bytes, n: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of the text's ``n``-word shingles."""
    from xxhash import xxh64_intdigest
    ones, total, last = np.zeros(64, np.int64), 0, []
    for piece in pieces(text):
        words = last + piece.lower().split()  # bytes: A-Z only, and the contract's six spaces
        runs = map(b" ".join, zip(*(words[k:] for k in range(n))))
        h = np.fromiter(map(xxh64_intdigest, runs, repeat(SEED)), np.uint64, max(0, len(words) - n + 1))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(h)
        last = words[-(n - 1):] if n > 1 else []
    if not total:
        return xxh64_intdigest(b" ".join(last), SEED) if last else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp``: the fingerprint as a signed long."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
                       F.col(text_col).cast("string").alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in slices(batches, "text"):
            fp = np.array([simhash(t, n) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fp)],
                                             names=["doc_id", "text_hash", "fp"])

    return base.mapInArrow(run, f"doc_id {kind}, text_hash bigint, fp bigint")


def byte_mask(positions) -> int:
    """Signed long with the bytes at ``positions`` set."""
    mask = sum(0xFF << (8 * p) for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


TRIPLES = [c for half in (range(4), range(4, 8)) for c in combinations(half, 3)]


def near(fp: np.ndarray, others: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Matrix of links: tally shared positional bytes, keep pairs at the
    guaranteed minimum, verify bits."""
    x = fp[:, None] ^ others[None, :]
    tally = (x.view(np.uint8).reshape(len(fp), len(others), 8) == 0).sum(axis=2, dtype=np.uint8)
    return (tally >= 8 - max_bits) & (np.bitwise_count(x) <= max_bits)


def forest(fp: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links (root, member) of each component: breadth first from the smallest
    fingerprint left; a fingerprint is compared with those not reached yet."""
    roots, members = [], []
    rest = fp
    while len(rest) > 1:
        root, rest, front = rest[0], rest[1:], rest[:1]
        while len(front) and len(rest):
            hit = near(front[:256], rest, max_bits).any(axis=0)
            roots.append(np.full(int(hit.sum()), root))
            members.append(rest[hit])
            front, rest = np.concatenate([front[256:], rest[hit]]), rest[~hit]
    return (np.concatenate(roots), np.concatenate(members)) if roots else (fp[:0], fp[:0])


def forest_dense(fp: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """The same over the cube of the bits in which the fingerprints differ at
    all: ``max_bits`` rounds of taking the smallest label across every bit give
    the smallest label within that distance."""
    differ = int(np.bitwise_or.reduce(fp ^ fp[0]))
    where = [b for b in range(64) if differ >> b & 1]
    bits = len(where)
    at = np.zeros(len(fp), np.int64)
    for i, b in enumerate(where):
        at |= ((fp >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << i
    label = np.arange(len(fp), dtype=np.int32)
    while True:
        cube = np.full(1 << bits, len(fp), np.int32)
        cube[at] = label
        for _ in range(max_bits):
            wider = cube.copy()
            for b in range(bits):
                pairs, out = cube.reshape(-1, 2, 1 << b), wider.reshape(-1, 2, 1 << b)
                np.minimum(out, pairs[:, ::-1], out=out)
            cube = wider
        new = np.minimum(label, cube[at])
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    member = label != np.arange(len(fp))
    return fp[label[member]], fp[member]


def posting_links(postings: DataFrame, max_bits: int, dense: int = DENSE) -> DataFrame:
    """``a, b``: spanning links of every posting list ``(mask, masked)``."""

    def link(mask: int, fp: np.ndarray):
        free = sum(not (mask >> (8 * p)) & 255 for p in range(8))
        return forest(fp, max_bits) if len(fp) <= dense or free > 3 else forest_dense(fp, max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the list that may go on in the next batch
        open_key = None
        for b in batches:
            mask, key = b.column("mask").to_numpy(), b.column("masked").to_numpy()
            fp = b.column("fp").to_numpy().view(np.uint64)
            edge = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            found = []
            for i, j in zip([0, *edge.tolist()], [*edge.tolist(), len(fp)]):
                if i == j:
                    continue
                k = (int(mask[i]), int(key[i]))
                if k != open_key:
                    if sum(map(len, held)) > 1:
                        found.append(link(open_key[0], np.concatenate(held)))
                    held, open_key = [], k
                held.append(fp[i:j])
            yield as_links(found)
        if sum(map(len, held)) > 1:
            yield as_links([link(open_key[0], np.concatenate(held))])

    def as_links(found) -> pa.RecordBatch:
        cols = [np.concatenate([f[i] for f in found]).view(np.int64) if found else np.zeros(0, np.int64)
                for i in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["a", "b"])

    return (postings.repartition("mask", "masked").sortWithinPartitions("mask", "masked", "fp")
            .mapInArrow(run, "a bigint, b bigint"))


def masked_by(fps: DataFrame, masks: list[int]) -> DataFrame:
    """``mask, masked, fp``: one posting per mask."""
    return fps.select("fp", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask")).select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("masked"), "fp")


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT, dense: int = DENSE) -> DataFrame:
    """Links between distinct fingerprints (read from storage) that connect all
    that are at most ``max_bits`` apart, directly or through others."""
    postings = masked_by(fps, [byte_mask(t) for t in TRIPLES])
    sizes = postings.groupBy("mask", "masked").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("mask").alias("k_mask"), F.col("masked").alias("k_masked"), "n")
    sized = postings.join(sizes, (F.col("mask") == F.col("k_mask")) & (F.col("masked") == F.col("k_masked"))).select(
        "mask", "masked", "fp", "n")
    cold = sized.where(F.col("n") <= hot).select("mask", "masked", "fp")
    # A long list goes to the ten five-byte keys that hold its three bytes.
    wider = F.lit(None).cast("array<bigint>")
    for t in TRIPLES:
        keys = [byte_mask((*t, *p)) for p in combinations([p for p in range(8) if p not in t], 2)]
        wider = F.when(F.col("mask") == F.lit(byte_mask(t)).cast("long"),
                       F.array(*[F.lit(k).cast("long") for k in keys])).otherwise(wider)
    finer = sized.where(F.col("n") > hot).select(F.explode(wider).alias("mask"), "fp").distinct().select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("masked"), "fp")
    return posting_links(cold.union(finer), max_bits, dense)


def grouped_rows(docs: DataFrame, n: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                 text_col: str = "text", hot: int = HOT, dense: int = DENSE) -> DataFrame:
    """``doc_id, text_hash, fp, component, component_id`` per row; ``component``
    (a fingerprint) tells groups apart, also where ids are null or repeated."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the index guarantees pairs of at most three differing bits")
    rows = written(fingerprints(docs, n, id_col, text_col), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    found = components(fingerprint_links(fps.select("fp"), max_bits, hot, dense))
    named = (fps.join(found, F.col("fp") == F.col("node"), "left")
             .select("fp", "first_id", F.coalesce("component", "fp").alias("component")))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id")).select(
        F.col("component").alias("c"), "component_id")
    of_fp = named.join(least, F.col("component") == F.col("c")).select(
        F.col("fp").alias("n_fp"), "component", "component_id")
    return rows.join(of_fp, F.col("fp") == F.col("n_fp")).drop("n_fp")


def near_duplicates(docs: DataFrame, **kwargs) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row."""
    return grouped_rows(docs, **kwargs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, **kwargs) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest id (null
    after all others), then the smallest text hash."""
    judged = grouped_rows(docs, **kwargs).groupBy("component", "doc_id", "text_hash").agg(
        F.count(F.lit(1)).alias("rows"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "rows"))
    kept = written(judged.groupBy("component").agg(first.alias("first")).select(
        F.col("first.doc_id").alias("_kept_id"), F.col("first.text_hash").alias("_kept_text"),
        F.col("first.rows").alias("_kept_rows")), "near_duplicates")
    text_hash = F.xxhash64(text_of())
    out = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept_id"]) & (text_hash == kept["_kept_text"]), "left_semi")
    if kept.where("_kept_rows > 1").isEmpty():
        return out
    # Rows repeated with one id and text.
    return out.withColumn("_kept_text", text_hash).dropDuplicates(["doc_id", "_kept_text"]).drop("_kept_text")
