import json

from eddyflow.operators import batch_offsets, latest_offsets, starting_offsets_json, unconsumed

LEDGER = [("g", "t", 0, 9), ("g", "t", 0, 5), ("g", "t", 1, 3), ("h", "t", 0, 99)]


def _ledger(spark):
    return spark.createDataFrame(LEDGER, "groupid string, topic string, partitioner int, offset bigint")


def test_latest_is_max_not_last_row(spark):
    got = {(r["partitioner"]): r["offset"] for r in latest_offsets(_ledger(spark), "g", ["t"]).collect()}
    assert got == {0: 9, 1: 3}


def test_group_filter_is_pushed(spark, tmp_path):
    path = str(tmp_path / "ledger")
    _ledger(spark).write.parquet(path)
    df = latest_offsets(spark.read.parquet(path), "g", ["t"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "groupid" in plan.split("PushedFilters")[1]


def test_batch_offsets_exclusive_end(spark):
    recs = spark.createDataFrame([("t", 0, 4), ("t", 0, 7), ("t", 1, 0)], "topic string, partition int, offset bigint")
    got = {(r["topic"], r["partitioner"]): r["offset"] for r in batch_offsets(recs, "g").collect()}
    assert got == {("t", 0): 8, ("t", 1): 1}


def test_unconsumed_resumes_and_starts_missing_partitions_at_zero(spark):
    recs = spark.createDataFrame([("t", 0, o) for o in range(12)] + [("t", 1, o) for o in range(5)]
                                 + [("t", 2, o) for o in range(2)],
                                 "topic string, partition int, offset bigint")
    latest = latest_offsets(_ledger(spark), "g")
    got = sorted((r["partition"], r["offset"]) for r in unconsumed(recs, latest).collect())
    assert got == [(0, 9), (0, 10), (0, 11), (1, 3), (1, 4), (2, 0), (2, 1)]


def test_starting_offsets_json(spark):
    rows = latest_offsets(_ledger(spark), "g").collect()
    spec = json.loads(starting_offsets_json(rows, {"t": 3}))
    assert spec == {"t": {"0": 9, "1": 3, "2": -2}}
    assert starting_offsets_json([], {"t": 3}) == "earliest"


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["g", "h"]), st.sampled_from(["t", "u"]), st.integers(0, 3),
                          st.integers(0, 10**6)), min_size=1, max_size=40))
def test_latest_is_order_independent(spark, rows):
    df = spark.createDataFrame(rows, "groupid string, topic string, partitioner int, offset bigint")
    got = {(r["groupid"], r["topic"], r["partitioner"]): r["offset"]
           for r in latest_offsets(df.repartition(4)).collect()}
    want = {}
    for g, t, p, o in rows:
        want[(g, t, p)] = max(o, want.get((g, t, p), o))
    assert got == want
