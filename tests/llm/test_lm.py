import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eddyflow.llm.eliasfano import BLOCK, EliasFano, ef_encode
from eddyflow.llm.ngramlm import PRIOR, SPREAD, fit_and_score, pack_pairs, shard_of, unpack_pairs

SCHEMA = "doc_id long, text string, held_out string, floor int, h long, c long, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows], SCHEMA)


def stored(values):
    return EliasFano(np.frombuffer(ef_encode(np.array(values, np.uint64)), np.uint8))


@given(st.lists(st.integers(0, 2**64 - 1), max_size=300), st.lists(st.integers(0, 2**64 - 1), max_size=50))
@settings(max_examples=150, deadline=None)
def test_elias_fano_round_trip_and_successor(values, queries):
    values = sorted(values)
    ef = stored(values)
    assert ef.values().tolist() == values
    queries = sorted(queries + values[::7])
    index, found = ef.successor(np.array(queries, np.uint64))
    for q, i, v in zip(queries, index.tolist(), found.tolist()):
        want = next((k for k, x in enumerate(values) if x >= q), len(values))
        assert i == want and v == (values[want] if want < len(values) else 0)


def test_elias_fano_over_many_blocks():
    rng = np.random.default_rng(1)
    values = np.sort(rng.integers(0, 1 << 40, 3 * BLOCK + 17, dtype=np.uint64))
    ef = stored(values)
    assert np.array_equal(ef.values(), values)
    at = np.unique(rng.integers(0, len(values), 500))
    assert np.array_equal(ef.get(at), values[at])
    q = np.sort(rng.integers(0, 1 << 41, 4000, dtype=np.uint64))
    index, _ = ef.successor(q)
    assert np.array_equal(index, np.searchsorted(values, q, "left"))
    assert len(ef_encode(values)) < 0.6 * values.nbytes


def test_packed_pairs_round_trip():
    rng = np.random.default_rng(2)
    c, w, d = np.sort(rng.integers(0, 1 << 33, 99)), rng.integers(0, 1 << 31, 99), rng.integers(0, 50, 99)
    t = rng.integers(0, 2, 99).astype(bool)
    for a, b in zip(unpack_pairs(pack_pairs(c, w, d, t)), (c, w, d, t)):
        assert np.array_equal(a, b)


def test_a_frequent_context_takes_several_shards():
    words = np.arange(5000)
    hot = shard_of(np.full(5000, 7), words, np.full(5000, 400.0), 16, 100)
    cold = shard_of(np.full(5000, 7), words, np.full(5000, 99.0), 16, 100)
    assert len(set(hot.tolist())) == 5 and len(set(cold.tolist())) == 1


def rows_of(n=80):
    rng = random.Random(3)
    vocab = [f"Word{i}" for i in range(60)] + ["the"] * 30
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(n)]
    return rows + [(500, None), (501, ""), (502, "never-seen before\x1c \x0b ÄÄ"), (503, rows[0][1]), (503, rows[0][1])]


def brute(rows):
    tokens = lambda t: [x.lower() if x.isascii() else x for x in
                        (t or "").encode().lower().decode().replace("\x0b", " ").replace("\n", " ").split(" ") if x] + [0]
    out_fold = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    one, two, docs = Counter(), Counter(), 0
    for i, t in rows:
        if not out_fold(i):
            w = tokens(t)
            one.update(w)
            two.update(zip([None, *w], w))
            docs += 1
    n, v = sum(one.values()), len(one)
    out = []
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((one[x] + 1) / (n + (v + 1))) for x in w)
        score = 0.0
        for b, x in zip([None, *w], w):
            p, c = (one[x] + 1) / (n + v + 1), docs if b is None else one[b]
            m = PRIOR * c ** SPREAD if c else 1.0
            score += math.log10((two[b, x] + m * p) / (c + m))
        out.append((i, out_fold(i), len(w), sum(one[x] > 0 for x in w), n, base, score))
    return out


@pytest.mark.parametrize("shard_tokens", [4_000_000, 150])
def test_scores_against_brute_force(spark, shard_tokens):
    rows = rows_of()
    got = fit_and_score(frame(spark, rows), shard_tokens=shard_tokens).collect()
    key = lambda r: (r[0], r[2])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(brute(rows), key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], abs=1e-9)
        assert g[6] == pytest.approx(w[6], abs=0.012 * w[2] + 1e-9)  # 8-bit levels


def test_held_out_texts_score_better_than_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = fit_and_score(docs).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert r["s"] > r["b"]


def test_nothing_to_learn_from_and_empty_table(spark):
    only = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 2)
    got = fit_and_score(frame(spark, [(only, "a b")])).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got] == [(3, 0, 0, 0.0)]
    assert fit_and_score(frame(spark, [])).count() == 0
    assert fit_and_score(frame(spark, [(None, "a"), (None, "a")])).count() == 2
