import random

import brute
import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eddyflow.llm.packing import combinations, pack_documents, plan_packing, solve_nnls, token_pieces
from eddyflow.llm.tokens import WordEncoder, tokenised, vocabulary_path, write_tokens
from eddyflow.session import shared_path

SCHEMA = "doc_id long, text string, part int, tokens string, base long, _bin int, slot int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], SCHEMA)


def rows_of(seed=0, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(1, 9)))
    rows = [(i, " ".join(word() + rng.choice(["", "", ",", ".", "!!", "'s"]) for _ in range(rng.randint(0, 900))))
            for i in rng.sample(range(1000), n)]
    return rows + [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "x " * 30000), (2004, "Ünïcode, ΑΣ. 日本語 ½!"),
                   (2005, "same"), (2005, "same")]


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(vocabulary_path(), cache_words=50)


@given(st.lists(st.text(alphabet="aB zé.,'!\u0301Σσİ0½日\n\t\x0b\x1c\x85\u00a0<|endoftxsr>", max_size=25), min_size=1,
                max_size=4))
@settings(max_examples=200, deadline=None)
def test_word_by_word_encoding_equals_the_tokenizer(encoder, texts):
    ids, offsets = encoder.encode([t.encode() for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == brute.token_ids(texts)


def test_pieces_cut_at_white_space():
    from eddyflow.llm.tokens import pieces
    text = b"ab cd\tef  gh" * 7
    for size in (1, 3, 10, 1000):
        assert b"".join(pieces(text, size)) == text
        assert [w for p in pieces(text, size) for w in p.split()] == text.split()
    assert list(pieces(b"x" * 50, 10)) == [b"x" * 50] and list(pieces(b"")) == [b""]


def test_token_files(spark):
    rows = sorted(rows_of(), key=lambda r: r[0])
    ids = brute.token_ids([t for _, t in rows])
    start, want = 0, []
    for (i, _), x in zip(rows, ids):
        want.append((i, start, len(x), brute.crc(x)))
        start += len(x)
    got = tokenised(frame(spark, rows[::-1]), partitions=5).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want


def test_files_ascend_and_have_page_indexes(spark):
    path = shared_path(spark, "t")
    write_tokens(frame(spark, rows_of()), path, partitions=3)
    local = path.removeprefix("file:")
    import glob
    last = None
    for f in sorted(glob.glob(f"{local}/part-*.parquet")):
        t = pq.read_table(f)
        ids = t["doc_id"].to_pylist()
        assert ids == sorted(ids) and (last is None or last <= ids[0])
        last = ids[-1]
        meta = pq.ParquetFile(f).metadata.row_group(0)
        chunk = meta.column(meta.num_columns - 1)
        assert chunk.has_column_index and chunk.has_offset_index
        assert any("DICTIONARY" in e or "DELTA" in e for e in chunk.encodings)
    assert spark.read.parquet(path).where("doc_id = 2003").select("n_tokens").count() == 1


def test_null_ids_sort_first(spark):
    got = tokenised(frame(spark, [(3, "b"), (None, "a a")]), partitions=2).collect()
    assert sorted((str(r["doc_id"]), r["start"]) for r in got) == [("3", 3), ("None", 0)]


def test_empty_tables(spark):
    assert tokenised(frame(spark, [])).count() == 0
    assert pack_documents(frame(spark, [])).count() == 0


def check_packing(rows, got, window):
    ids = brute.token_ids([t for _, t in rows])
    pieces = {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for k in {k for k, _ in rows}:
        own = [x for (i, _), x in zip(rows, ids) if i == k]
        have = sorted(pieces.pop(k))
        want = sorted((s, len(x[s:s + window]), brute.crc(x[s:s + window]), len(x)) for x in own
                      for s in range(0, len(x), window))
        assert have == want
    assert not pieces
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(seqs) == list(range(len(seqs)))
    return 1 - sum(r["length"] for r in got) / (window * len(seqs))


@pytest.mark.parametrize("window", [4096, 64])
def test_packing(spark, window):
    rows = rows_of(3)
    got = pack_documents(frame(spark, rows), window=window, bins=min(256, window)).collect()
    padding = check_packing(rows, got, window)
    if window == 64:
        assert padding < 0.02


def test_real_documents_pack_with_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert check_packing(rows, pack_documents(docs).collect(), 4096) < 0.03


def test_pieces_with_null_id(spark):
    got = pack_documents(frame(spark, [(None, "a b"), (1, "c")])).collect()
    assert {(r["doc_id"], r["length"]) for r in got} == {(None, 3), (1, 2)}
    assert token_pieces(frame(spark, [])).count() == 0


def test_nnls_reaches_the_least_squares_of_a_small_case():
    members = np.array([[4, 0, 0], [2, 2, 0], [1, 3, 0], [1, 1, 2]])
    h = np.array([0, 10, 20, 3, 5])
    x = solve_nnls(members, h)
    a = np.zeros((5, 4))
    for j, m in enumerate(members):
        for b in m:
            a[b, j] += b > 0
    grad = a[1:].T @ (a[1:] @ x - h[1:])
    assert (x >= 0).all() and (grad > -1e-3).all() and abs(grad[x > 1e-6]).max() < 1e-3


@given(st.lists(st.integers(0, 50), min_size=17, max_size=17))
@settings(max_examples=60, deadline=None)
def test_plan_places_every_piece_once(counts):
    h = np.array([0, *counts[1:]])
    blocks = plan_packing(h, 16)
    fill = {}
    for b in range(1, 17):
        mine = sorted((x.low, x.high) for x in blocks if x.bin == b)
        assert [lo for lo, _ in mine] == [0, *[hi for _, hi in mine[:-1]]][:len(mine)]
        assert (mine[-1][1] if mine else 0) == h[b]
    for x in blocks:
        for r in range(x.high - x.low):
            fill.setdefault(x.first + r % x.repeats, []).append((x.slot + r // x.repeats, x.bin))
    for s in fill.values():
        assert sum(b for _, b in s) <= 16 and len({k for k, _ in s}) == len(s)


def test_combinations_fill_the_window():
    c = combinations(30)
    assert len(set(c)) == len(c) and all(sum(x) == 30 and list(x) == sorted(x) for x in c)
    assert len(c) == sum(1 for a in range(1, 31) for b in range(0, 31) for d in range(0, 31)
                         if a + b + d == 30 and (b == d == 0 or (d == 0 and 0 < a <= b) or 0 < a <= b <= d))
