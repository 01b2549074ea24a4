"""Physical-plan properties the design relies on."""


import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from eddyflow.operators import prepare_ranges, range_lookup
from eddyflow.plans.queries import QUERIES
from eddyflow.sources.orderlog import order_log_from_tables
from eddyflow.streaming.ledger import Ledger

SF = "/root/testdata/sf0.001"
# Streaming queries run their streams when called; their result plans are reads of ledgers.
BATCH_QUERIES = sorted(k for k in QUERIES if k not in {
    "word_count_per_batch", "word_count_running", "word_state_capped", "order_running_metrics", "order_resume_totals",
    "offset_ledger_latest"})


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_nested_loop_or_cartesian(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_generated_code_always_compiles(spark, name):
    """No fallback to interpreted execution because code grew too large."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")


def test_order_log_scans_only_needed_columns(spark):
    plan = _plan(entry.queries()["order_total_income"](spark, SF))
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in plan
    assert "l_comment" not in plan and "l_shipdate" not in plan
    assert "struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_word_count_combines_before_shuffle(spark):
    plan = _plan(entry.queries()["word_count"](spark, SF))
    assert "partial_count" in plan


def test_metrics_single_aggregate(spark):
    plan = _plan(entry.queries()["order_metrics_one_pass"](spark, SF))
    assert "Expand" in plan and plan.count("partial_sum") == 2 and "ArrowEvalPython" in plan
    assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize("name", ["order_total_income", "order_income_by_category", "order_income_by_zone",
                                  "order_metrics_one_pass", "metric_store_scan"])
def test_an_order_line_is_made_once(spark, name, monkeypatch):
    """No null test on the price carries the line's whole expression into a join."""
    plans = []
    monkeypatch.setattr(Ledger, "write", lambda self, rows, *_: plans.append(_plan(rows)))
    monkeypatch.setattr(Ledger, "read", lambda self, spark: spark.createDataFrame([], self.schema))
    plans.append(_plan(entry.queries()[name](spark, SF)))
    assert sum(p.count("regexp_replace") for p in plans) == 1


def test_lineitem_is_dealt_only_where_no_join_shuffles_it(spark):
    assert "RoundRobin" in _plan(order_log_from_tables(spark, SF))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = order_log_from_tables(spark, SF)
        assert "SortMergeJoin" in _plan(log) and "RoundRobin" not in _plan(log)
        assert log.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**20), st.integers(0, 2**18)), min_size=1, max_size=12),
       st.lists(st.integers(0, 2**21), min_size=1, max_size=40),
       st.sampled_from([4, 12, 16]))
def test_range_lookup_matches_brute_force(spark, spans, points, bits):
    # Build non-overlapping rules from (gap, length) pairs.
    rules, pos = [], 0
    for i, (gap, length) in enumerate(spans):
        start = pos + gap
        rules.append((start, start + length, f"r{i}"))
        pos = start + length + 1
    rdf = spark.createDataFrame(rules, "start_num bigint, end_num bigint, province string")
    pdf = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "id int, p bigint")
    got = {r["id"]: r["province"] for r in
           range_lookup(pdf, F.col("p"), prepare_ranges(rdf, bucket_bits=bits), how="left").collect()}
    want = {}
    for i, p in enumerate(points):
        hits = [name for s, e, name in rules if s <= p <= e]
        want[i] = hits[0] if hits else None
    assert got == want
