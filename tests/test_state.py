"""State updates given by the user, and state moved between queries."""

import os
import time

from eddyflow.operators import word_count
from eddyflow.streaming import run_to_end, start_running_word_count
from eddyflow.streaming.state import add_up, start_running_state, state_partitions, stored_state


def _files(path, texts):
    os.makedirs(path, exist_ok=True)
    for i, text in enumerate(texts):
        with open(os.path.join(path, f"{time.time_ns()}-{i}.txt"), "w") as f:
            f.write(text)
        time.sleep(0.05)
    return path


def _stream(spark, path):
    return spark.readStream.option("maxFilesPerTrigger", 1).text(path)


def test_an_update_that_is_no_sum(spark, tmp_path):
    def last_and_batches(word, n, old):
        return {"last": n, "batches": (old["batches"] if old else 0) + 1, "most": max(n, old["most"] if old else 0)}

    src = _files(str(tmp_path / "src"), ["a a b\n", "a c\n", "b b b\na\n"])
    changed = []
    initial = spark.createDataFrame([("c", 9, 4, 9), ("z", 1, 1, 1)], "word string, last bigint, batches bigint, most bigint")
    ck = str(tmp_path / "ck")
    run_to_end(start_running_state(_stream(spark, src), last_and_batches, "last bigint, batches bigint, most bigint",
                                   lambda b, i: changed.append({tuple(r) for r in b.collect()}), ck,
                                   trigger="available_now", state_partitions=3, initial=initial), 180)
    assert [c for c in changed if c] == [{("a", 2, 1, 2), ("b", 1, 1, 1)}, {("a", 1, 2, 2), ("c", 1, 5, 9)},
                                         {("a", 1, 3, 2), ("b", 3, 2, 3)}]
    assert {tuple(r) for r in stored_state(spark, ck).collect()} == {
        ("a", 1, 3, 2), ("b", 3, 2, 3), ("c", 1, 5, 9), ("z", 1, 1, 1)}


def test_a_count_moves_to_more_state_partitions(spark, tmp_path):
    first, then = (_files(str(tmp_path / d), texts) for d, texts in (
        ("first", ["a b a\n", "c a\n", "d d\n"]), ("then", ["a e\n", "b b\n", "c\n"])))
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    run_to_end(start_running_word_count(_stream(spark, first), str(tmp_path / "out"), old, "value", "available_now",
                                        state_partitions=4), 180)
    assert state_partitions(spark, old) == 4
    held = stored_state(spark, old, own_update=False)
    assert {tuple(r) for r in held.collect()} == {("a", 3), ("b", 1), ("c", 1), ("d", 2)}
    run_to_end(start_running_state(_stream(spark, then), add_up, "cnt bigint", lambda b, i: b.count(), new,
                                   trigger="available_now", state_partitions=7, initial=held), 180)
    assert state_partitions(spark, new) == 7
    bounded = word_count(spark.read.text([first, then]), "value")
    assert {tuple(r) for r in stored_state(spark, new).collect()} == {tuple(r) for r in bounded.collect()}
