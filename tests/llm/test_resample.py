import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from eddyflow.llm.resample import FOLD, CrcShift, WordDictionary, resample, run_crcs

SCHEMA = "doc_id long, text string, id string, row int, buckets int, weight string, rank int"
TARGET = "item_id long, text string, bucket int"


def features(text, max_run, buckets):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    runs = [" ".join(ws[i:i + n]) for n in range(1, max_run + 1) for i in range(len(ws) - n + 1)]
    return len(ws), [zlib.crc32(r.encode()) % buckets for r in runs]


def plain(docs, target, max_run=1, buckets=10_000, min_words=20, percent=10):
    own = [(i, *features(t, max_run, buckets)) for i, t in docs]
    s = Counter(f for *_, fs in own for f in fs)
    t = Counter(f for x in target for f in features(x, max_run, buckets)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
            for b in range(buckets)]
    rows = []
    for i, n_words, fs in own:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[f] for f in fs)
        rows.append((i, n_words, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = [(i, n, w, sc, k) for k, (i, _, n, w, sc) in enumerate(able[:len(able) * percent // 100], 1)]
    rest = [(i, n, w, sc, None) for i, _, n, w, sc in able[len(able) * percent // 100:]]
    return sorted(map(repr, drawn + rest + [(i, n, w, sc, None) for i, nw, n, w, sc in rows if nw < min_words]))


def run(spark, docs, target, **kwargs):
    d = spark.createDataFrame([(*r, "x", 7, 8, "w", 9) for r in docs], SCHEMA)
    t = spark.createDataFrame([(k, x, 5) for k, x in enumerate(target)], TARGET)
    return sorted(map(repr, (tuple(r) for r in resample(d, t, **kwargs).select(
        "doc_id", "n_features", "weight", "score", "rank").collect())))


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = ["Alpha", "beta2", "été", "日本", "x", "ÀB", "long" * 40, "z9", "the", "of"]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", "-", "\n", "\x00", "_ "]) for _ in range(n))
    rows = [(i, text(rng.randint(0, 60))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " .,;\t"), (203, "x " * 300_000), (204, "y" * 3_000_000), (None, text(40))]
    rows += [(7, rows[7][1])] * 3 + [(8, text(50)), (300, rows[30][1]), (301, rows[30][1])]
    return rows, [text(30) for _ in range(20)] + [None, ""]


@pytest.mark.parametrize("max_run,buckets", [(1, 10_000), (3, 97), (2, 100_000)])
def test_against_brute_force(spark, max_run, buckets):
    docs, target = corpus()
    assert run(spark, docs, target, max_run=max_run, buckets=buckets, percent=30) == plain(
        docs, target, max_run, buckets, percent=30)


def test_payloads_compose_to_crcs_of_runs():
    texts = [b"one Two  three-FOUR", b"", b"a" * 200 + b" x y " + b"b" * 70 + b" x", "é日 本".encode()]
    folded = [t.translate(FOLD) for t in texts]
    words, shift = WordDictionary(folded), CrcShift()
    for t in folded:
        ws = t.split()
        want = [zlib.crc32(b" ".join(ws[i:i + n])) for n in (1, 2, 3) for i in range(len(ws) - n + 1)]
        assert run_crcs(words.payloads(t), 3, shift).tolist() == want


def test_shift_is_the_register_after_zero_bytes():
    shift, rng = CrcShift(), np.random.default_rng(1)
    for n in (0, 1, 5, 1000):
        a, b = rng.bytes(9), rng.bytes(n)
        moved = int(shift(np.array([zlib.crc32(a)], np.uint32), np.array([n]))[0])
        assert moved ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_empty_tables(spark):
    assert run(spark, [], ["a b"]) == []
    docs, _ = corpus()
    assert run(spark, docs, []) == plain(docs, [])


def test_all_rows_equal(spark):
    docs = [(1, "word " * 25)] * 50
    assert run(spark, docs, ["word"]) == plain(docs, ["word"])
