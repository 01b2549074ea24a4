import math
import os
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eddyflow.functions import parse_order_lines
from eddyflow.functions.exactsum import exact_parts, exact_totals
from eddyflow.operators import (flat_view, income_by_category, metric_deltas, metrics_one_pass,
                                prepare_ranges, running_totals, total_income)
from eddyflow.sources import read_order_log
from eddyflow.streaming import lines_with_province

SAMPLE = os.path.join(os.path.dirname(__file__), "data", "order_sample.log")
GOLDEN_CATEGORY = {"kitchen": 119.0, "garden": 67.75, "toys": 27.75, "books": 69.0}
GOLDEN_PROVINCE = {"east": 111.25, "west": 114.0, "": 58.25}
GOLDEN_TOTAL = 283.5


def _lines(spark):
    return parse_order_lines(read_order_log(spark, SAMPLE))


def _rules(spark):
    # 61.20.0.0/16 is east, 77.1.0.0 to 77.3.255.255 west; other addresses have no rule.
    df = spark.createDataFrame([((61 << 24) | (20 << 16), (61 << 24) | (21 << 16) - 1, "east"),
                                ((77 << 24) | (1 << 16), (77 << 24) | (4 << 16) - 1, "west")],
                               "start_num bigint, end_num bigint, province string")
    return prepare_ranges(df)


def test_total_income_golden(spark):
    assert total_income(_lines(spark)).first()["total_income"] == GOLDEN_TOTAL


def test_income_by_category_golden(spark):
    got = {r["category"]: r["income"] for r in income_by_category(_lines(spark)).collect()}
    assert got == GOLDEN_CATEGORY


def test_one_pass_metrics(spark):
    rows = metrics_one_pass(lines_with_province(_lines(spark), _rules(spark))).collect()
    got = {(r["metric"], r["key"]): r["income"] for r in rows}
    assert got[("total", "TOTAL_INCOME")] == GOLDEN_TOTAL
    for k, v in GOLDEN_CATEGORY.items():
        assert got[("category", k)] == v
    for k, v in GOLDEN_PROVINCE.items():
        assert got[("province", k)] == v
    assert sum(v for (m, _), v in got.items() if m == "province") == GOLDEN_TOTAL


def test_empty_input_adds_no_delta(spark):
    empty = _lines(spark).where(F.lit(False))
    assert metric_deltas(lines_with_province(empty, _rules(spark))).count() == 0


def test_flat_view_merges_same_key(spark):
    added = spark.createDataFrame([("category", "X", 10.0, 0), ("province", "X", 5.0, 0),
                                   ("total", "TOTAL_INCOME", 15.0, 0), ("category", "X", 1.0, 1)],
                                  "metric string, key string, delta double, batch_id bigint")
    ledger = exact_parts(added, ["metric", "key", "batch_id"], "delta")
    flat = {r["key"]: r["value"] for r in flat_view(ledger).collect()}
    assert flat == {"X": 16.0, "TOTAL_INCOME": 15.0}
    totals = {(r["metric"], r["key"]): r["income"] for r in running_totals(ledger).collect()}
    assert totals[("category", "X")] == 11.0 and totals[("province", "X")] == 5.0


def test_decimal_sum_is_order_independent(spark):
    vals = [0.1] * 10 + [1e9, -1e9]
    df = spark.createDataFrame([(v,) for v in vals], "price double").repartition(5)
    assert total_income(df).first()[0] == 1.0


def test_large_and_tiny_prices_keep_every_digit(spark):
    line = lambda p: (f"B 61.20.0.1 c i {p}",)
    def totals(lines):
        parsed = parse_order_lines(spark.createDataFrame(lines, "value string"))
        rows = metrics_one_pass(lines_with_province(parsed, _rules(spark))).collect()
        assert repr(total_income(parsed).first()[0]) == repr({r["metric"]: r["income"] for r in rows}["total"])
        return {r["metric"]: r["income"] for r in rows}["total"]
    assert totals([line("9.0e15"), line("9.0e15")]) == 1.8e16
    assert totals([line("0.004")] * 1000) == 4.0
    assert totals([line("0.0000000001")]) == 1e-10
    assert totals([line("0.123456789"), line("1e30"), line("-1e30")]) == 0.123456789
    assert totals([line("1e-300"), line("5e-324"), line("1e300"), line("-1e300")]) == 1e-300
    assert totals([line("1.7e308"), line("1.7e308")]) == float("inf")
    assert totals([line("1.7e308"), line("1.7e308"), line("-1.7e308")]) == 1.7e308
    assert math.isnan(totals([line("NaN"), line("2.5")]))
    assert math.isnan(totals([line("Infinity"), line("-Infinity")]))
    assert totals([line("-Infinity"), line("2.5")]) == float("-inf")


def _true_sum(xs):
    total = sum(Fraction(x) for x in xs)
    try:
        return total.numerator / total.denominator
    except OverflowError:
        return float("inf") if total > 0 else float("-inf")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=12), min_size=1, max_size=8))
def test_sums_are_exact_and_rounded_once(spark, groups):
    rows = [(k, x) for k, xs in enumerate(groups) for x in [*xs, *(-x for x in xs[1:])]]
    df = spark.createDataFrame(rows, "k int, x double").repartition(3)
    got = {r["k"]: r["s"] for r in exact_totals(exact_parts(df, ["k"], "x"), ["k"], "s").collect()}
    assert got == {k: _true_sum([x for j, x in rows if j == k]) for k in range(len(groups))}


def test_sums_of_no_prices(spark):
    nulls = spark.createDataFrame([("a", None)], "category string, price double")
    assert total_income(nulls).first()[0] is None
    assert income_by_category(nulls).count() == 0
    assert total_income(spark.createDataFrame([(0.0,), (-0.0,)], "price double")).first()[0] == 0.0


def test_null_prices_leave_no_parts(spark):
    rows = [("a", 1.5), ("a", None), ("b", None), (None, 2.0), (None, None), ("c", float("nan"))]
    parts = exact_parts(spark.createDataFrame(rows, "category string, price double"), ["category"], "price")
    assert parts.columns == ["category", "exponent", "units"]
    assert sorted(str(r["category"]) for r in parts.collect()) == ["None", "a", "c"]


def test_grouping_sets_expand_sums_not_lines(spark):
    plan = metric_deltas(lines_with_province(_lines(spark), _rules(spark)))._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    assert text.index("Expand") < text.rindex("Aggregate [category")
