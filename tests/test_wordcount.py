from pyspark.sql import functions as F

from eddyflow.operators import sorted_word_count, top_words, word_count, word_count_per_batch, with_global_position

TEXTS = ["a b", "a  b", "b c c", "", "   ", "d\ne"]


def _df(spark):
    return spark.createDataFrame([(t,) for t in TEXTS], "text string")


def test_word_count(spark):
    got = {r["word"]: r["cnt"] for r in word_count(_df(spark)).collect()}
    assert got == {"a": 2, "b": 3, "c": 2, "": 2, "d\ne": 1}


def test_per_batch(spark):
    df = spark.createDataFrame([(0, "a b"), (1, "a"), (1, "a")], "b int, text string")
    got = {(r["batch_id"], r["word"]): r["cnt"] for r in word_count_per_batch(df, "b").collect()}
    assert got == {(0, "a"): 1, (0, "b"): 1, (1, "a"): 2}


def test_top_words_order_and_plan(spark):
    counts = word_count(_df(spark))
    top = top_words(counts, 2)
    assert [tuple(r) for r in top.collect()] == [("b", 3), ("", 2)]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_sorted_positions(spark):
    rows = sorted_word_count(word_count(_df(spark))).orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(1, len(rows) + 1))
    keys = [(r["cnt"], r["word"]) for r in rows]
    assert keys == sorted(keys)


def test_global_position_over_many_partitions(spark):
    df = spark.range(0, 5000, numPartitions=13).select((F.col("id") * 7919 % 5000).alias("v"))
    rows = with_global_position(df, [F.col("v").asc()]).collect()
    assert sorted((r["position"], r["v"]) for r in rows) == [(i + 1, i) for i in range(5000)]


def _java_words(text):
    if text == "":
        return [""]
    parts = text.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


from collections import Counter  # noqa: E402

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=15), min_size=1, max_size=30))
def test_word_count_property(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = {r["word"]: r["cnt"] for r in word_count(df).collect()}
    want = Counter(w for t in texts for w in _java_words(t))
    assert got == dict(want)
