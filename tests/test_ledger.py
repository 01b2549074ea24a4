"""The ledgers' base: tiers of sorted parts, crashes between merge and switch, keyed reads."""

import os

import pytest
from pyspark.sql import functions as F

from eddyflow.streaming import order_totals, running_counts
from eddyflow.streaming.ledger import TIER_PARTS, Ledger, metric_ledger, per_batch_ledger, running_ledger

OWNER = "words"


def _batch(spark, i, n):
    return spark.range(i * n, (i + 1) * n).select(F.format_string("w%08d", "id").alias("word"), F.lit(1).cast("bigint").alias("cnt"))


def _rows_written(spark, ledger, number):
    return spark.read.schema(ledger.schema).parquet(ledger._part(OWNER, number)).count()


def test_rows_rewritten_do_not_grow_with_all_keys(spark, tmp_path):
    ledger, n, folds, written = per_batch_ledger(str(tmp_path / "l")), 100, 16, 0
    for i in range(folds):
        ledger.write(_batch(spark, i, n), OWNER, "r", i)
        ledger.fold(spark, OWNER, "r", i)
        written += _rows_written(spark, ledger, i)
    # Once a tier (16 folds make three), not once a fold (13,600 rows).
    assert written <= 3 * folds * n
    tiers = list(ledger.parts(spark, OWNER).values())
    assert all(tiers.count(t) < TIER_PARTS for t in tiers)
    assert ledger.folded(ledger.read(spark, OWNER)).agg(F.count("*"), F.sum("cnt")).first() == (folds * n, folds * n)
    assert len(os.listdir(f"{ledger.path}/_parts/{OWNER}")) <= (TIER_PARTS - 1) * 2 + 1  # those of two versions


def test_keys_of_all_tiers_add_up(spark, tmp_path):
    ledger = per_batch_ledger(str(tmp_path / "l"))
    for i in range(9):
        ledger.write(_batch(spark, 0, 10), OWNER, "r", i)
        if i % 3 == 0:
            ledger.fold(spark, OWNER, "r", i)
            ledger.fold(spark, OWNER, "r", i)  # again: nothing is left to fold
    assert {r["cnt"] for r in ledger.folded(ledger.read(spark, OWNER)).collect()} == {9}
    assert set(ledger.parts(spark, OWNER).values()) == {0, 1}


@pytest.mark.parametrize("dies_at", ["part", "merged", "switch"])
def test_a_fold_that_dies_before_the_switch_changes_nothing(spark, tmp_path, dies_at, monkeypatch):
    ledger, last = per_batch_ledger(str(tmp_path / "l")), TIER_PARTS - 1
    for i in range(last):
        ledger.write(_batch(spark, i, 10), OWNER, "r", i)
        ledger.fold(spark, OWNER, "r", i)
    ledger.write(_batch(spark, last, 10), OWNER, "r", last)
    before = ledger.parts(spark, OWNER)
    write_part = Ledger._write_part

    def dying(self, rows, owner, part):
        if dies_at == "part":
            os.makedirs(self._part(owner, part))  # a folder without a file
            raise RuntimeError("crash")
        write_part(self, rows, owner, part)  # the merge of a whole tier
        if dies_at == "merged":
            raise RuntimeError("crash")
        os.makedirs(f"{self._base(owner)}/v={part}/covers")  # the switch itself, half done
        raise RuntimeError("crash")

    monkeypatch.setattr(Ledger, "_write_part", dying)
    with pytest.raises(RuntimeError, match="crash"):
        ledger.fold(spark, OWNER, "r", last)
    monkeypatch.undo()
    for _ in range(2):
        assert ledger.folded(ledger.read(spark, OWNER)).agg(F.count("*"), F.sum("cnt")).first() == (10 * (last + 1),) * 2
        assert ledger.parts(spark, OWNER) == before
        if dies_at:
            ledger.fold(spark, OWNER, "r", last)
            before, dies_at = {last: 1}, ""


def _scanned(df):
    """Rows that the Parquet scans of ``df`` handed over, after it ran."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        elif node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_reading_one_key_skips_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("eddyflow.streaming.ledger.ROW_GROUP_BYTES", 64 << 10)
    ledger, n = running_ledger(str(tmp_path / "l")), 200_000
    ledger.write(_batch(spark, 0, n), OWNER, "r", 0)
    ledger.fold(spark, OWNER, "r", 0)
    ledger.write(_batch(spark, 0, 10).withColumn("cnt", F.lit(5).cast("bigint")), OWNER, "other", 0)
    one = running_counts(spark, ledger.path, F.col("word") == "w00000007")
    assert [(r["word"], r["cnt"]) for r in one.collect()] == [("w00000007", 6)]
    assert _scanned(ledger.find(spark, OWNER, F.col("word") == "w00000007")) < n / 2
    assert _scanned(ledger.find(spark, OWNER, F.col("word") == "w00000007x")) < n / 2
    few = ledger.find(spark, OWNER, F.col("word").startswith("w00012"))
    assert few.count() == 1000 and _scanned(few) < n / 2
    assert _scanned(ledger.folded(ledger.read(spark, OWNER))) >= n


def test_one_total_and_missing_keys(spark, tmp_path):
    from eddyflow.functions.exactsum import exact_parts
    path = str(tmp_path / "m")
    rows = spark.createDataFrame([("category", "a", 1.5), ("category", "b", 2.0), ("total", "T", 3.5)],
                                 "metric string, key string, price double")
    metric_ledger(path).write(exact_parts(rows, ["metric", "key"], "price"), "q", "r", 0)
    metric_ledger(path).fold(spark, "q", "r", 0)
    assert [tuple(r) for r in order_totals(spark, path, "q", wanted=F.col("key") == "a").collect()] == [("category", "a", 1.5)]
    assert order_totals(spark, path, "q", wanted=F.col("key") == "none").count() == 0
    assert running_counts(spark, str(tmp_path / "nothing"), F.col("word") == "a").count() == 0
