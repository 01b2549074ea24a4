import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eddyflow.functions import ip_to_number
from eddyflow.operators import RangeRuleError, point_lookup, prepare_ranges, range_lookup
from eddyflow.sources import parse_rule_lines

# Rule A = 16.0.0.0-18.255.255.255, B = 20.0.0.0-22.255.255.255.
RULE_LINES = [
    "16.0.0.0|18.255.255.255|268435456|318767103|x|y|A|z",
    "20.0.0.0|22.255.255.255|335544320|385875967|x|y|B",
]
EDGE_CASES = [
    ("16.0.0.0", "A"), ("18.255.255.255", "A"), ("19.0.0.0", ""), ("20.0.0.0", "B"),
    ("15.255.255.255", ""), ("23.0.0.0", ""), ("17.5.6.7", "A"), ("22.255.255.255", "B"),
]


@pytest.fixture()
def rules(spark):
    return parse_rule_lines(spark.createDataFrame([(line,) for line in RULE_LINES], "value string"))


def _lookup(spark, rules, **kw):
    table = prepare_ranges(rules, **kw)
    ips = spark.createDataFrame([(ip,) for ip, _ in EDGE_CASES], "ip string")
    out = range_lookup(ips, ip_to_number(F.col("ip")), table, how="left")
    return out.select("ip", F.coalesce("province", F.lit("")).alias("p")), table


def test_rule_parse(rules):
    assert [tuple(r) for r in rules.collect()] == [(268435456, 318767103, "A"), (335544320, 385875967, "B")]


@pytest.mark.parametrize("line", ["1|2|3", "a|b|1|2|c|d|", "a|b|x|2|c|d|P"])
def test_rule_parse_strict(spark, line):
    # a trailing '|' leaves six fields, as Java's split drops the empty one
    df = spark.createDataFrame([(line,)], "value string")
    with pytest.raises(Exception, match="malformed ip rule"):
        parse_rule_lines(df).collect()


@pytest.mark.parametrize("bits", [16, 8, 24])
def test_edges_broadcast(spark, rules, bits):
    out, table = _lookup(spark, rules, bucket_bits=bits)
    assert {r["ip"]: r["p"] for r in out.collect()} == dict(EDGE_CASES)


def test_plan_is_hash_join_not_nested_loop(spark, rules):
    out, _ = _lookup(spark, rules)
    assert out.count() == len(EDGE_CASES)
    out.collect()  # Spark decides by the measured size of the bucket table
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan


def test_shuffled_join_where_spark_may_not_broadcast(spark, rules):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out, _ = _lookup(spark, rules)
        assert {r["ip"]: r["p"] for r in out.collect()} == dict(EDGE_CASES)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_unmatched_rows_are_kept_once(spark, rules):
    out, _ = _lookup(spark, rules)
    assert out.count() == len(EDGE_CASES)


def test_overlap_is_rejected(spark):
    df = spark.createDataFrame([(0, 100, "a"), (50, 150, "b")], "start_num bigint, end_num bigint, province string")
    with pytest.raises(RangeRuleError, match="overlap"):
        prepare_ranges(df)


def test_overlap_across_bucket_edge_is_rejected(spark):
    k = 1 << 16
    df = spark.createDataFrame([(0, 3 * k, "a"), (3 * k, 4 * k, "b")], "start_num bigint, end_num bigint, province string")
    with pytest.raises(RangeRuleError):
        prepare_ranges(df)


def test_inverted_is_rejected(spark):
    df = spark.createDataFrame([(100, 50, "a")], "start_num bigint, end_num bigint, province string")
    with pytest.raises(RangeRuleError, match="start > end"):
        prepare_ranges(df)


def test_point_lookup_demo_ip(spark):
    # A rule holding the demo address 114.215.43.42 (= 1926703914).
    df = spark.createDataFrame([(1926703904, 1926703920, "demo"), (0, 10, "other")],
                               "start_num bigint, end_num bigint, province string")
    assert [r["province"] for r in point_lookup(df, 1926703914).collect()] == ["demo"]
    assert point_lookup(df, 20).count() == 0


def test_hot_bucket_in_shuffled_fallback(spark):
    """A third of the points in one bucket, rules too big to broadcast:
    AQE splits the hot partition and every row still gets its rule."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        rules = spark.createDataFrame([(i << 16, (i << 16) + 1000, f"r{i}") for i in range(64)],
                                      "start_num bigint, end_num bigint, province string")
        table = prepare_ranges(rules)
        n = 30000
        pts = spark.range(n).select(
            F.col("id"),
            F.when(F.col("id") % 3 == 0, F.lit(5 << 16) + F.col("id") % 1000)      # hot bucket 5
             .otherwise(F.shiftleft(F.col("id") % 64, 16) + F.col("id") % 1500).alias("p"))
        out = range_lookup(pts, F.col("p"), table).select("id", "p", "province")
        rows = out.collect()
        assert len(rows) == n
        for r in rows:
            b, off = r["p"] >> 16, r["p"] & 0xFFFF
            assert r["province"] == (f"r{b}" if off <= 1000 else None)
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in final and "NestedLoop" not in final
        assert "isFinalPlan=true" in final and "skew=true" in final
    finally:
        for k in confs:
            spark.conf.unset(k)


def test_null_point_matches_nothing(spark):
    rules = spark.createDataFrame([(0, 10, "a")], "start_num bigint, end_num bigint, province string")
    pts = spark.createDataFrame([(1, None), (2, 0)], "id int, p bigint")
    got = {r["id"]: r["province"] for r in range_lookup(pts, F.col("p"), prepare_ranges(rules)).collect()}
    assert got == {1: None, 2: "a"}


def test_rules_without_bounds_are_rejected(spark):
    df = spark.createDataFrame([(None, 5, "a"), (7, 9, "b")], "start_num bigint, end_num bigint, province string")
    with pytest.raises(RangeRuleError, match="no bounds"):
        prepare_ranges(df)


def test_bad_rules_go_to_rejects(spark, tmp_path):
    from eddyflow.sources import read_ip_rules_with_rejects
    (tmp_path / "rules.txt").write_text(RULE_LINES[0] + "\na|b|x|2|c|d|P\n1|2|3\n")
    good, bad = read_ip_rules_with_rejects(spark, str(tmp_path / "rules.txt"))
    assert [tuple(r) for r in good.collect()] == [(268435456, 318767103, "A")]
    assert sorted(r["line"] for r in bad.collect()) == ["1|2|3", "a|b|x|2|c|d|P"]


# Rules wider than any bucket table: swept.

LOW, HIGH = -(2**63) + 2, 2**63 - 1


def _by_hand(rules, points):
    return {i: next((n for s, e, n in rules if p is not None and s <= p <= e), None) for i, p in enumerate(points)}


def _swept(spark, rules, points, how="left", **kw):
    rdf = spark.createDataFrame(rules, "start_num bigint, end_num bigint, province string")
    pdf = spark.createDataFrame(list(enumerate(points)), "id int, p bigint")
    table = prepare_ranges(rdf, **kw)
    assert table.bucket_bits is None
    return range_lookup(pdf, F.col("p"), table, how=how).select("id", "province")


@settings(max_examples=8, deadline=None)
@given(st.sets(st.integers(LOW, HIGH), min_size=2, max_size=40), st.lists(st.integers(LOW, HIGH) | st.none(), max_size=30))
def test_rules_of_any_width_match_brute_force(spark, ends, points):
    ends = sorted(ends)
    rules = [(a, b, f"r{a}") for a, b in zip(ends[::2], ends[1::2])]
    points = points + [p + d for s, e, _ in rules for p in (s, e) for d in (-1, 0, 1) if LOW <= p + d <= HIGH]
    got = {r["id"]: r["province"] for r in _swept(spark, rules, points, max_buckets=0).collect()}
    assert got == _by_hand(rules, points)


def test_wide_rules_are_swept_without_being_asked(spark):
    rules = [(0, 2**62, "wide"), (2**62 + 1, HIGH, "rest")]
    points = [0, 2**62, 2**62 + 1, HIGH, -1, None, 5]
    got = {r["id"]: r["province"] for r in _swept(spark, rules, points, "left").collect()}
    assert got == _by_hand(rules, points)
    inner = {r["id"]: r["province"] for r in _swept(spark, rules, points, "inner").collect()}
    assert inner == {i: p for i, p in _by_hand(rules, points).items() if p}


def test_a_hot_point_is_dealt_over_sub_cells(spark):
    rules = [(i * 2**50, i * 2**50 + 2**49, f"r{i}") for i in range(300)]
    points = [7 * 2**50 + 5] * 4000 + [i * 2**49 for i in range(600)]
    out = _swept(spark, rules, points)
    assert {r["id"]: r["province"] for r in out.collect()} == _by_hand(rules, points)
    plan = out._jdf.queryExecution().optimizedPlan()
    assert "Join" not in plan.toString()
    sizes = (out.groupBy("province").count().collect())
    assert max(r["count"] for r in sizes) >= 4000


def test_sweep_equals_buckets(spark, rules):
    points = [ip for ip, _ in EDGE_CASES]
    df = spark.createDataFrame([(p,) for p in points], "ip string")
    look = lambda t: {tuple(r) for r in range_lookup(df, ip_to_number(F.col("ip")), t).collect()}
    assert look(prepare_ranges(rules)) == look(prepare_ranges(rules, max_buckets=0))


def test_overlap_of_wide_rules_is_rejected(spark):
    df = spark.createDataFrame([(0, 2**62, "a"), (2**61, 2**61 + 5, "b")], "start_num bigint, end_num bigint, province string")
    with pytest.raises(RangeRuleError, match="overlap"):
        prepare_ranges(df)


def test_many_rules_are_checked_by_cells(spark, monkeypatch):
    from eddyflow.operators import rangejoin
    monkeypatch.setattr(rangejoin, "SMALL_BYTES", 0)
    fine = [(i * 10, i * 10 + 9, str(i)) for i in range(5000)]
    schema = "start_num bigint, end_num bigint, province string"
    assert prepare_ranges(spark.createDataFrame(fine, schema)).bucket_bits == 16
    for bad in [(25_000, 25_000, "x"), (-5, 60_000, "x"), (49_999, 70_000, "x")]:
        with pytest.raises(RangeRuleError, match="overlap"):
            prepare_ranges(spark.createDataFrame([*fine, bad], schema))
