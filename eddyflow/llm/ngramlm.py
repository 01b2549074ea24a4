"""Language-model scoring with an n-gram trie in Elias-Fano form.

Model: words and an end mark; the probability of a word after its predecessor is
    p(w|b) = (c(bw) + m(b) p(w)) / (c(b) + m(b)),   m(b) = PRIOR c(b) ^ SPREAD,
    p(w)   = (c(w) + 1) / (N + V + 1),
a proper distribution whose share of unseen words shrinks as the context grows.
``b`` of a text's first token is a start mark.

Vocabulary and unigram level: sorted word hashes, counts and quantised
probabilities, in files by hash range (bounded size), memory-mapped by tasks;
a word's id is its rank.  Bigram level: a trie per shard of contexts: context
ids, monotone pointers to their successors, successor ids shifted by the
context's rank so that the whole level ascends (all in Elias-Fano form), and
probabilities quantised to 8 bits.  A pair is looked up by finding its context,
then the successor of its shifted id within that context's range.

A task turns a slice of documents (``SLICE_BYTES``) into its distinct pairs by
shard, each with its training count (sorted, byte planes, zstd); which document has
which pair stays with the slice.  A shard's task adds the counts up, writes its
trie, maps it and looks its pairs up; it returns, per slice, what each pair gains
over backing off, and the slice adds that up by document.  However often a pair
occurs, a shard gets it once a slice.  Shards get about
``SHARD_TOKENS`` training tokens, so their number grows with the corpus; the
successors of a context too frequent for one shard are dealt over several (the
smoothing needs only c(b), which the unigram level has).

Defined results: a null or empty text is the end mark alone; words are compared
by 64-bit hash; with no training text every count is 0; a null id counts as the
empty string when folds are dealt; repeated rows are separate documents, in
training too; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .common import written
from .eliasfano import EliasFano, ef_encode
from .tokens import pieces, slices
from .warc import open_store

FOLDS, HELD_OUT = 7, 2
PRIOR, SPREAD = 5.0, 0.8
SEED = 42
END = b"\n"  # no word has white space in it
SHARD_TOKENS = 1_500_000
VOCAB_WORDS = 1_000_000
SLICE_BYTES = 4 << 20
CACHE_WORDS = 1 << 20
LEVELS = 256


def held_out(id_col: str = "doc_id", folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


class _Codes(dict):
    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        return code


def token_codes(codes: _Codes, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(codes of all tokens, end marks included; tokens per text)."""
    out: list[int] = []
    n = np.empty(len(texts), np.int64)
    look_up = codes.__getitem__
    end = look_up(END)
    for i, t in enumerate(texts):
        before = len(out)
        for piece in pieces(t):
            out.extend(map(look_up, piece.lower().split()))
        out.append(end)
        n[i] = len(out) - before
    return np.fromiter(out, np.int64, len(out)), n


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest
    return np.fromiter(map(xxh64_intdigest, words, repeat(SEED)), np.uint64, len(words))


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``h, c``: hash and count of every token of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = _Codes(), np.zeros(0, np.int64)

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(word_hashes(list(codes)).view(np.int64)), pa.array(counts)], names=["h", "c"])

        for _, texts in slices(batches, "text", SLICE_BYTES):
            if len(codes) > CACHE_WORDS:
                yield out()
                codes, counts = _Codes(), np.zeros(0, np.int64)
            tokens, _ = token_codes(codes, texts)
            new = np.bincount(tokens, minlength=len(codes))
            new[:len(counts)] += counts
            counts = new
        if len(codes):
            yield out()

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "h bigint, c bigint")
    return rows.groupBy("h").agg(F.sum("c").alias("c"))


def put_file(path: str, data: bytes) -> str:
    """Write a file whole or not at all: under a name of its own, then moved."""
    store, where = open_store(path)
    store.create_dir(where.rsplit("/", 1)[0], recursive=True)
    own = f"{where}.{uuid.uuid4().hex}"
    with store.open_output_stream(own, compression=None) as f:
        f.write(data)
    store.move(own, where)
    return path


def map_file(path: str) -> np.ndarray:
    """The bytes of a file, memory-mapped where the store is a mounted one."""
    from pyarrow import fs
    store, where = open_store(path)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(where, dtype=np.uint8, mode="r")
    with store.open_input_file(where) as f:
        return np.frombuffer(f.read_buffer(), np.uint8)


def pack_arrays(arrays: list[np.ndarray]) -> bytes:
    """Arrays of bytes one after the other, each starting at a multiple of 8."""
    sizes = np.array([len(arrays), *(len(a) for a in arrays)], "<u8")
    return sizes.tobytes() + b"".join(a.tobytes() + bytes(-len(a) % 8) for a in arrays)


def unpack_arrays(data: np.ndarray) -> list[np.ndarray]:
    n = int(data[:8].view("<u8")[0])
    sizes = data[8:8 * (n + 1)].view("<u8").astype(np.int64)
    at = 8 * (n + 1) + np.concatenate([[0], np.cumsum(sizes + (-sizes) % 8)])
    return [data[a:a + s] for a, s in zip(at, sizes)]


def as_bytes(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.uint8)


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codebook of at most 256 evenly spaced values, code of each value)."""
    low, high = (float(values.min()), float(values.max())) if len(values) else (0.0, 0.0)
    book = np.linspace(low, high, LEVELS)
    step = (high - low) / (LEVELS - 1)
    codes = np.rint((values - low) / step) if step > 0 else np.zeros(len(values))
    return book, codes.astype(np.uint8)


class Vocabulary:
    """The unigram level: files of ascending hash ranges, opened when needed."""

    def __init__(self, files: list[tuple[int, int, str]], bits: int, total: int, documents: int):
        self.bits, self.total, self.documents = bits, total, documents
        self.size = sum(n for _, n, _ in files)
        self.by_bucket = {}
        self.starts = []
        self.files: list[str] = []
        self.opened: dict[int, list[np.ndarray]] = {}
        at = 0
        for bucket, n, path in sorted(files):
            self.by_bucket[bucket] = len(self.files)
            self.starts.append(at)
            self.files.append(path)
            at += n
        self.unknown, self.start = self.size, self.size + 1

    def part(self, k: int) -> list[np.ndarray]:
        """(hashes, counts) of a file."""
        if k not in self.opened:
            self.opened[k] = [x.view("<u8") for x in unpack_arrays(map_file(self.files[k]))]
        return self.opened[k]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids; ``unknown`` for words that training has not."""
        out = np.full(len(hashes), self.unknown, np.int64)
        bucket = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        for b in np.unique(bucket).tolist():
            if b in self.by_bucket:
                k = self.by_bucket[b]
                own, mine = self.part(k)[0], np.flatnonzero(bucket == b)
                at = np.minimum(np.searchsorted(own, hashes[mine]), len(own) - 1)
                hit = own[at] == hashes[mine]
                out[mine[hit]] = self.starts[k] + at[hit]
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Training counts of ids; those of the start mark are the documents."""
        out = np.zeros(len(ids), np.float64)
        out[ids == self.start] = self.documents
        part = np.searchsorted(self.starts, ids, "right") - 1
        for k in np.unique(part[ids < self.size]).tolist():
            mine = np.flatnonzero((part == k) & (ids < self.size))
            out[mine] = self.part(k)[1][ids[mine] - self.starts[k]]
        return out

    def log_unigram(self, counts: np.ndarray) -> np.ndarray:
        """log10 p(w), quantised to 256 levels."""
        low = -np.log10(self.total + self.size + 1)
        exact = np.log10(counts + 1) + low
        return np.rint((exact - low) / -low * (LEVELS - 1)) * -low / (LEVELS - 1) + low if low else exact


def mass(context_counts: np.ndarray) -> np.ndarray:
    """m(b); contexts that training has not leave everything to p(w)."""
    return np.where(context_counts > 0, PRIOR * np.maximum(context_counts, 1.0) ** SPREAD, 1.0)


def log_back_off(context_counts: np.ndarray) -> np.ndarray:
    m = mass(context_counts)
    return np.log10(m / (context_counts + m))


def write_vocabulary(counts: DataFrame, path: str) -> tuple[list[tuple[int, int, str]], int, int]:
    """Files by hash range; ((bucket, words, path) of each, bits, all tokens)."""
    whole = counts.agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n")).first()
    bits = max(0, (whole["v"] // VOCAB_WORDS).bit_length())

    def run(key, group):
        h = group.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        data = pack_arrays([as_bytes(h[order].astype("<u8")),
                            as_bytes(group.column("c").to_numpy()[order].astype("<u8"))])
        bucket = key[0].as_py()
        return pa.table({"bucket": [bucket], "n": [len(h)], "file": [put_file(f"{path}/words-{bucket:08d}", data)]})

    bucket = F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")
    files = written(counts.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(
        run, "bucket bigint, n bigint, file string"), "lm")
    # One row per million words.
    return [(r["bucket"], r["n"], r["file"]) for r in files.collect()], bits, whole["n"] or 0


def spread_ids(ids: np.ndarray) -> np.ndarray:
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)


def shard_of(context: np.ndarray, word: np.ndarray, counts: np.ndarray, shards: int, quota: int) -> np.ndarray:
    """A context's shard; one with more than ``quota`` training tokens takes a
    run of shards, dealt by the word."""
    runs = np.minimum(shards, 1 + (counts // quota).astype(np.int64))
    return (spread_ids(context) + spread_ids(word) % runs) % shards


def facts_group(number: int) -> int:
    """Where the documents' own numbers of a slice go: a group of its own beside
    the shards (all 64 bits of ``number`` count: the low ones are the slice's
    place within its partition)."""
    return -1 - number


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers in byte planes, zstd."""
    raw = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(len(numbers), 4).T).tobytes()
    return np.array([len(raw)], "<u8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_numbers(data: bytes) -> np.ndarray:
    size = int(np.frombuffer(data[:8], "<u8")[0])
    raw = np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, size // 4).T).view("<u4").ravel()


def pack_pairs(context: np.ndarray, word: np.ndarray, count: np.ndarray, train: np.ndarray) -> bytes:
    """Pairs sorted by context, a 32-bit number and a mark for each: differences and
    ids in byte planes, zstd."""
    gaps = np.diff(context, prepend=0).astype("<u8")
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()
              for x in (gaps, word.astype("<u8"), count.astype("<u4"))]
    raw = np.array([len(word)], "<u8").tobytes() + b"".join(planes) + np.packbits(train).tobytes()
    return np.array([len(raw)], "<u8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    size = int(np.frombuffer(data[:8], "<u8")[0])
    raw = np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    n = int(raw[:8].view("<u8")[0])

    def plane(at, width, kind):
        return np.ascontiguousarray(raw[at:at + n * width].reshape(width, n).T).view(kind).ravel().astype(np.int64)

    context, word = np.cumsum(plane(8, 8, "<u8")), plane(8 + 8 * n, 8, "<u8")
    return context, word, plane(8 + 16 * n, 4, "<u4"), np.unpackbits(raw[8 + 20 * n:], count=n).astype(bool)


def build_trie(pairs: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary) -> bytes:
    """Levels of the pairs ``context << 32 | word`` (ascending, distinct)."""
    context, word = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
    names, first, rank = np.unique(context, return_index=True, return_inverse=True)
    seen = vocabulary.counts(names)
    m = mass(seen)
    unigram = 10.0 ** vocabulary.log_unigram(vocabulary.counts(word))
    book, codes = quantise(np.log10((counts + m[rank] * unigram) / (seen + m)[rank]))
    shifted = rank.astype(np.uint64) * np.uint64(vocabulary.size + 2) + word.astype(np.uint64)
    pointers = np.append(first, len(pairs)).astype(np.uint64)
    return pack_arrays([np.frombuffer(ef_encode(x), np.uint8) for x in (names.astype(np.uint64), pointers, shifted)]
                       + [as_bytes(book), codes])


class Trie:
    """The bigram level of a shard, read from its (mapped) bytes."""

    def __init__(self, data: np.ndarray, words: int):
        names, pointers, shifted, book, self.codes = unpack_arrays(data)
        self.names, self.pointers, self.shifted = EliasFano(names), EliasFano(pointers), EliasFano(shifted)
        self.book, self.words = np.asarray(book).view(np.float64), words

    def log_probability(self, pairs: np.ndarray) -> np.ndarray:
        """Of ascending pairs; NaN where the trie has none."""
        context, word = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
        out = np.full(len(pairs), np.nan)
        asked, back = np.unique(context, return_inverse=True)
        at, name = self.names.successor(asked)
        known = (name == asked) & (at < len(self.names))
        low, high = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
        low[known] = self.pointers.get(at[known]).astype(np.int64)
        high[known] = self.pointers.get(at[known] + 1).astype(np.int64)
        ask = np.flatnonzero(known[back])
        own = back[ask]
        target = at[own].astype(np.uint64) * np.uint64(self.words + 2) + word[ask]
        index, value = self.shifted.successor(target)
        hit = (value == target) & (index >= low[own]) & (index < high[own])
        out[ask[hit]] = self.book[self.codes[index[hit]]]
        return out


def fit_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Learn from the rows outside the held-out fold, score all: ``doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    spark = docs.sparkSession
    path = shared_path(spark, "lm")
    base = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    training = base.where(~F.col("held_out"))
    counts = written(word_counts(training), "lm")
    files, bits, total = write_vocabulary(counts, path)
    documents = training.select("doc_id").count()
    if sum(n for _, n, _ in files) >= 1 << 32:
        raise ValueError("more than 2^32 different words")
    shards = max(1, -(-total // shard_tokens))
    quota = max(1, shard_tokens // 2)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(files, bits, total, documents)
        log_all = np.log10(total + (vocabulary.size + 1))
        codes, ids = _Codes(), np.zeros(0, np.int64)
        number = TaskContext.get().partitionId() << 32
        for b, texts in slices(batches, "text", SLICE_BYTES):
            if len(codes) > CACHE_WORDS:
                codes, ids = _Codes(), np.zeros(0, np.int64)
            tokens, n = token_codes(codes, texts)
            if codes.new:
                ids = np.concatenate([ids, vocabulary.find(word_hashes(codes.new))])
                codes.new = []
                seen = vocabulary.counts(ids)
                unigram, back = vocabulary.log_unigram(seen), log_back_off(seen)
                start_back = float(log_back_off(np.array([float(documents)]))[0])
            doc = np.repeat(np.arange(len(texts)), n)
            first = np.cumsum(n) - n
            word = ids[tokens]
            context, off = np.roll(word, 1), np.roll(back[tokens], 1)
            context[first], off[first] = vocabulary.start, start_back
            context_seen = np.roll(seen[tokens], 1)
            context_seen[first] = documents
            floor = np.bincount(doc, unigram[tokens] + off, len(texts))
            plain = np.bincount(doc, np.log10(seen[tokens] + 1) - log_all, len(texts))
            known = np.bincount(doc, seen[tokens] > 0, len(texts)).astype(np.int64)
            train = ~b.column("held_out").to_numpy(zero_copy_only=False)
            # Pairs with a word that training has not cannot be in the trie.
            ask = np.flatnonzero((word != vocabulary.unknown) & (context != vocabulary.unknown))
            pairs, first_at, place = np.unique(
                (context[ask].astype(np.uint64) << np.uint64(32)) | word[ask].astype(np.uint64),
                return_index=True, return_inverse=True)
            learned = np.bincount(place[train[doc[ask]]], minlength=len(pairs))
            left, right = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
            shard = shard_of(left, right, context_seen[ask][first_at], shards, quota)
            order = np.argsort(shard, kind="stable")  # pairs ascend within a shard
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            shard = shard[order]
            edges = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
            rows = [(int(shard[i]), number, pack_pairs(left[s], right[s], learned[s], learned[s] > 0))
                    for i, j in zip(edges, [*edges[1:], len(order)]) for s in [order[i:j]]]
            facts = pa.table([b.column("doc_id"), b.column("held_out"), pa.array(n), pa.array(known),
                              pa.array(plain), pa.array(floor)],
                             names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "floor"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, facts.schema) as w:
                w.write_table(facts)
            # The slice's own numbers, and the pair of each token by its place among
            # the pairs in order of their shards, pass by the shards' tasks.
            own = pack_arrays([np.frombuffer(x, np.uint8) for x in (
                sink.getvalue().to_pybytes(), pack_numbers(doc[ask]), pack_numbers(rank[place]))])
            rows.append((facts_group(number), number, own))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                              pa.array([r[1] for r in rows], pa.int64()),
                                              pa.array([r[2] for r in rows], pa.binary())],
                                             names=["shard", "slice", "data"])
            number += 1

    def score_shard(key, group):
        shard = key[0].as_py()
        if shard < 0:
            return group.select(["slice", "data"]).append_column("shard", pa.array([-1] * len(group), pa.int64()))
        parts = [unpack_pairs(x) for x in group.column("data").to_pylist()]
        context, word, learned, _ = (np.concatenate(x) for x in zip(*parts))
        ends = np.cumsum([len(p[0]) for p in parts])
        pairs = (context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)
        del parts, context, word  # a shard's arrays are the task's memory
        asked, back = np.unique(pairs, return_inverse=True)
        counts = np.bincount(back, learned, len(asked)).astype(np.int64)
        del pairs, learned
        vocabulary = Vocabulary(files, bits, total, documents)
        name = f"{path}/pairs-{shard:08d}"
        put_file(name, build_trie(asked[counts > 0], counts[counts > 0], vocabulary))
        trie = Trie(map_file(name), vocabulary.size)
        ids = (asked >> np.uint64(32)).astype(np.int64), (asked & np.uint64(0xFFFFFFFF)).astype(np.int64)
        floor = log_back_off(vocabulary.counts(ids[0])) + vocabulary.log_unigram(vocabulary.counts(ids[1]))
        gain = np.nan_to_num(trie.log_probability(asked) - floor).astype("<f4")[back]
        out = [gain[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends)]
        return pa.table({"slice": group.column("slice"), "data": pa.array(out, pa.binary()),
                         "shard": pa.array([shard] * len(out), pa.int64())})

    def add_up(group):
        rows = sorted(zip(group.column("shard").to_pylist(), group.column("data").to_pylist()))
        facts, doc, place = unpack_arrays(np.frombuffer(rows[0][1], np.uint8))  # shard -1
        facts = pa.ipc.open_stream(pa.py_buffer(facts)).read_all()
        gain = np.concatenate([np.zeros(0, "<f4"), *(np.frombuffer(data, "<f4") for _, data in rows[1:])])
        score = facts.column("floor").to_numpy() + np.bincount(
            unpack_numbers(doc.tobytes()), gain[unpack_numbers(place.tobytes())].astype(np.float64), len(facts))
        return facts.drop_columns(["floor"]).append_column("score", pa.array(score)).append_column(
            "train_tokens", pa.array(np.full(len(score), total, np.int64)))

    schema = (f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, "
              "train_tokens bigint")
    routed = base.mapInArrow(route, "shard bigint, slice bigint, data binary")
    scored = routed.groupBy("shard").applyInArrow(score_shard, "slice bigint, data binary, shard bigint")
    return scored.groupBy("slice").applyInArrow(add_up, schema).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
