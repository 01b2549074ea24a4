import random

import numpy as np
import pytest
from trie_brute import trie

from eddyflow.llm.prefixtrie import DoubleArray, conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, c int, lead string, depth int, items int"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(spark, rows, parts=None, **kwargs):
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)
    got = [tuple(r[c] for c in NODE) for r in conversation_trie(df.repartition(parts) if parts else df, **kwargs).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_shared_openings_in_small_shards(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["u", "a", None]), rng.choice(["x", "yy", "zzé", None, ""]))
            for c in range(400) for t in range(rng.randint(1, 7))]
    assert nodes(spark, rows, parts=5, shard_turns=100) == trie(rows)


@pytest.fixture(scope="module")
def deep_rows():
    rng = random.Random(2)
    rows = [(c, t, "u", str(rng.randint(0, 1))) for c in range(120) for t in range(rng.choice([1, 3, 16, 17, 32, 33, 40]))]
    rows += [(50, 1000 + t, "u", f"turn {t}") for t in range(1500)]  # a conversation with a third of all rows
    rows += [(100, None, "u", "no turn"), (-105, 1, "x", "y"), (-100, 1, "q", "y"), (None, 1, "a", "b"),
             (300, 1, "u", "z" * 2_000_000), (301, 5, "u", "tie"), (301, 5, "u", "tie"), (301, 5, "a", "tie")]
    return rows


def test_long_conversations_over_many_segments(spark, deep_rows):
    assert nodes(spark, deep_rows, shard_turns=64) == trie(deep_rows)


def test_one_row_a_partition(spark, deep_rows):
    rows = deep_rows[-60:-8] + deep_rows[:200]
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        assert nodes(spark, rows, shard_turns=1) == trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_copies_and_conversations_without_turns(spark):
    rows = [(c, 0, "u", "hello") for c in range(3000)] + [(c, 1, "a", "again") for c in range(0, 3000, 7)]
    assert nodes(spark, rows) == trie(rows)


def test_empty_table(spark):
    assert nodes(spark, []) == set() == nodes(spark, [(None, 1, "a", "b")])


def test_double_array_holds_exactly_its_paths():
    rng = np.random.default_rng(3)
    paths = np.unique(rng.integers(0, 40, (500, 3)), axis=0)
    array, state = DoubleArray(1), np.zeros(len(paths), np.int64)
    known = set()
    for d in range(3):
        pair = np.unique(np.stack([state, paths[:, d]]), axis=1)
        array.add_children(*pair)
        state = array.step(state, paths[:, d])
        for p, s in zip(paths[:, :d + 1].tolist(), state.tolist()):
            known.add((tuple(p), s))
    slots = [s for _, s in known]
    assert len(set(slots)) == len(slots) == len({p for p, _ in known})
    with pytest.raises(ValueError):
        array.step(np.zeros(1, np.int64), np.array([10_000 % len(array.check)]))
    assert (array.check == DoubleArray.FREE).sum() < len(array.check) / 2
