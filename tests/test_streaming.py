import os
import time

from pyspark.sql import functions as F

from eddyflow.functions import parse_order_lines
from eddyflow.functions.exactsum import exact_parts
from eddyflow.operators import metrics_one_pass, prepare_ranges, running_totals
from eddyflow.sinks import preview_writer
from eddyflow.sources import message_stream, records_from_events
from eddyflow.streaming import (OrderMetricsBatch, lines_with_province, order_totals, read_per_batch_counts,
                                run_to_end, running_counts, start_offset_ledger, start_order_metrics,
                                start_per_batch_word_count, start_running_word_count, stored_offsets)

SF = "/root/testdata/sf0.001"


def _write_text(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    time.sleep(0.05)


def test_running_count_two_batches(spark, tmp_path):
    src, out, ck = (str(tmp_path / d) for d in ("src", "out", "ck"))
    _write_text(src, "b1.txt", ["a", "b"])
    stream = spark.readStream.text(src)
    run_to_end(start_running_word_count(stream, out, ck, "value", "available_now", state_partitions=4), 120)
    assert {r["word"]: r["cnt"] for r in running_counts(spark, out).collect()} == {"a": 1, "b": 1}
    # batch 2 after a restart on the same checkpoint: counts carry over; b keeps 1
    _write_text(src, "b2.txt", ["a"])
    run_to_end(start_running_word_count(spark.readStream.text(src), out, ck, "value", "available_now"), 120)
    assert {r["word"]: r["cnt"] for r in running_counts(spark, out).collect()} == {"a": 2, "b": 1}


def test_running_count_leaves_session_conf(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    src, out, ck = (str(tmp_path / d) for d in ("src", "out", "ck"))
    _write_text(src, "b1.txt", ["x y"])
    run_to_end(start_running_word_count(spark.readStream.text(src), out, ck, "value", "available_now",
                                        state_partitions=3), 120)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_per_batch_has_no_memory(spark, tmp_path):
    src, out, ck = (str(tmp_path / d) for d in ("src", "out", "ck"))
    _write_text(src, "b1.txt", ["a b", "a"])
    run_to_end(start_per_batch_word_count(spark.readStream.text(src), out, ck, "value", "available_now"), 120)
    _write_text(src, "b2.txt", ["a"])
    run_to_end(start_per_batch_word_count(spark.readStream.text(src), out, ck, "value", "available_now"), 120)
    got = {(r["batch_id"], r["word"]): r["cnt"] for r in read_per_batch_counts(spark, out).collect()}
    assert got == {(0, "a"): 2, (0, "b"): 1, (1, "a"): 1}


def _stage(df, path, files, fmt="parquet"):
    df.repartition(files).write.format(fmt).save(path)


def _sf_rules(spark):
    from eddyflow.plans.queries import ip_rules
    return prepare_ranges(ip_rules(spark, SF))


def test_order_stream_equals_batch_and_retry_is_idempotent(spark, tmp_path):
    from eddyflow.sources import order_log_from_tables
    stage, ledger, ck = (str(tmp_path / d) for d in ("stage", "ledger", "ck"))
    log = order_log_from_tables(spark, SF)
    _stage(log, stage, 3, "text")
    rules = _sf_rules(spark)
    job = OrderMetricsBatch(rules, ledger, query="q1")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(stage)
    q = run_to_end(start_order_metrics(stream, job, ck, "available_now"), 300)
    assert q.lastProgress is not None
    batch = {(r["metric"], r["key"]): r["income"]
             for r in metrics_one_pass(lines_with_province(parse_order_lines(log), rules)).collect()}
    streamed = {(r["metric"], r["key"]): r["income"] for r in order_totals(spark, ledger, "q1").collect()}
    assert streamed == batch
    # re-running batch 0 (as after a failure) must not add it twice
    first = spark.read.text(stage).limit(50)
    job(first, 0)
    job(first, 0)
    # batch 0 now holds exactly the rows of `first`, counted once
    only_first = {(r["metric"], r["key"]): r["income"]
                  for r in metrics_one_pass(lines_with_province(parse_order_lines(first), rules)).collect()}
    ledger_rows = spark.read.parquet(ledger).where("run = 'direct' and batch_id = 0")
    got0 = {(r["metric"], r["key"]): r["income"] for r in running_totals(ledger_rows).collect()}
    assert got0 == only_first


def test_empty_batch_writes_nothing(spark, tmp_path):
    ledger, offsets = str(tmp_path / "ledger"), str(tmp_path / "offsets")
    job = OrderMetricsBatch(_sf_rules(spark), ledger, query="q", offset_ledger=offsets, group_id="g")
    empty = spark.createDataFrame([], "topic string, partition int, offset bigint, key string, value string")
    job(empty, 0)
    from eddyflow.sources import read_metric_store, read_offset_ledger
    assert read_metric_store(spark, ledger).count() == 0
    assert not os.path.exists(offsets) or read_offset_ledger(spark, offsets).count() == 0


def test_order_job_writes_offsets_after_deltas(spark, tmp_path):
    ledger, offsets = str(tmp_path / "ledger"), str(tmp_path / "offsets")
    job = OrderMetricsBatch(_sf_rules(spark), ledger, query="q", offset_ledger=offsets, group_id="g")
    recs = spark.createDataFrame([("orders", 0, 5, None, "A 16.0.0.1 c i 10"),
                                  ("orders", 0, 6, None, "A 200.0.0.1 c i 2.5"),
                                  ("orders", 1, 2, None, "B 16.0.0.2 d j 1")],
                                 "topic string, partition int, offset bigint, key string, value string")
    job(recs, 0)
    got = {(r["topic"], r["partitioner"]): r["offset"] for r in stored_offsets(spark, offsets, "g").collect()}
    assert got == {("orders", 0): 7, ("orders", 1): 3}
    totals = {(r["metric"], r["key"]): r["income"] for r in order_totals(spark, ledger, "q").collect()}
    assert totals[("total", "TOTAL_INCOME")] == 13.5 and totals[("province", "")] == 2.5


def test_offset_ledger_stream(spark, tmp_path):
    stage, ledger, ck = (str(tmp_path / d) for d in ("stage", "ledger", "ck"))
    recs = records_from_events(spark.read.parquet(f"{SF}/events.parquet"))
    recs.write.option("maxRecordsPerFile", 300).parquet(stage)
    stream = spark.readStream.schema(recs.schema).option("maxFilesPerTrigger", 1).parquet(stage)
    run_to_end(start_offset_ledger(stream, ledger, "g", ck, "available_now"), 300)
    got = {(r["topic"], r["partitioner"]): r["offset"] for r in stored_offsets(spark, ledger, "g").collect()}
    want = {(r["topic"], r["partition"]): r["m"] for r in
            recs.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("m")).collect()}
    assert got == want
    assert spark.read.parquet(ledger).select("batch_id").distinct().count() > 1


def test_rate_message_stream(spark, tmp_path):
    out_rows = []
    stream = message_stream(spark, rows_per_batch=5)
    q = (stream.writeStream.foreachBatch(lambda df, i: out_rows.extend(r["value"] for r in df.collect()))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(once=True).start())
    run_to_end(q, 120)
    assert sorted(out_rows) == sorted(f"message{n}" for n in range(1, 6))


def test_console_preview(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_text(src, "a.txt", ["x y", "y"])
    from eddyflow.operators import word_count
    counts = word_count(spark.readStream.text(src), "value")
    q = (preview_writer(counts, output_mode="complete")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    run_to_end(q, 120)


def test_permissive_batch_routes_rejects(spark, tmp_path):
    from eddyflow.sources import read_metric_store
    ledger, rejects = str(tmp_path / "ledger"), str(tmp_path / "rejects")
    job = OrderMetricsBatch(_sf_rules(spark), ledger, query="q", strict=False, reject_path=rejects)
    lines = spark.createDataFrame([("A 16.0.0.1 c i 10",), ("broken line",), ("B 16.0.0.2 c i notaprice",),
                                   ("B not.an.ip c i 5",)],
                                  "value string")
    job(lines, 3)
    totals = {(r["metric"], r["key"]): r["income"] for r in order_totals(spark, ledger, "q").collect()}
    assert totals[("total", "TOTAL_INCOME")] == 10.0
    bad = spark.read.parquet(rejects)
    assert bad.count() == 3 and {r["batch_id"] for r in bad.collect()} == {3}
    assert read_metric_store(spark, ledger).where("batch_id = 3").count() == 3


def test_running_count_complete_mode_matches_update(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_text(src, "b1.txt", ["a b c", "a"])
    _write_text(src, "b2.txt", ["c c", "d"])
    results = {}
    for mode in ("update", "complete"):
        out, ck = str(tmp_path / f"out-{mode}"), str(tmp_path / f"ck-{mode}")
        stream = spark.readStream.option("maxFilesPerTrigger", 1).text(src)
        run_to_end(start_running_word_count(stream, out, ck, "value", "available_now", state_partitions=2,
                                            output_mode=mode), 120)
        results[mode] = {r["word"]: r["cnt"] for r in running_counts(spark, out).collect()}
    assert results["update"] == results["complete"] == {"a": 2, "b": 1, "c": 3, "d": 1}
    # complete mode wrote every key in the second batch, update mode only the changed ones
    assert spark.read.parquet(str(tmp_path / "out-complete")).where("batch_id = 1").count() == 4
    assert spark.read.parquet(str(tmp_path / "out-update")).where("batch_id = 1").count() == 2


def test_keyed_per_batch_counts_span_micro_batches(spark, tmp_path):
    from eddyflow.streaming import per_key_counts
    src, out, ck = (str(tmp_path / d) for d in ("src", "out", "ck"))
    rows = [(0, "a b"), (0, "a"), (1, "a"), (1, "c c"), (0, "b")]
    df = spark.createDataFrame(rows, "turn bigint, value string")
    df.repartition(5).write.partitionBy("turn").parquet(src)
    stream = spark.readStream.schema("value string, turn bigint").option("maxFilesPerTrigger", 1).parquet(src)
    run_to_end(start_per_batch_word_count(stream, out, ck, "value", "available_now", keys=("turn",)), 120)
    assert spark.read.parquet(out).select("batch_id").distinct().count() > 2   # several micro-batches
    got = {(r["turn"], r["word"]): r["cnt"] for r in per_key_counts(spark, out, "turn bigint").collect()}
    assert got == {(0, "a"): 2, (0, "b"): 2, (1, "a"): 1, (1, "c"): 2}


class _CrashAfterWrite:
    """Runs the job, then fails once on one batch: the sink has written but
    Spark has not committed the batch, as when a driver dies mid-batch."""

    def __init__(self, job, batch_id):
        self.job, self.batch_id, self.crashed = job, batch_id, False

    def __call__(self, df, batch_id):
        self.job(df, batch_id)
        if batch_id == self.batch_id and not self.crashed:
            self.crashed = True
            raise RuntimeError("simulated crash after the ledger write")


def test_crash_and_restart_counts_each_batch_once(spark, tmp_path):
    import pytest as _pytest
    from eddyflow.sources import order_log_from_tables
    stage, ledger, ck = (str(tmp_path / d) for d in ("stage", "ledger", "ck"))
    log = order_log_from_tables(spark, SF)
    _stage(log, stage, 4, "text")
    rules = _sf_rules(spark)
    job = OrderMetricsBatch(rules, ledger, query="crash")
    crashing = _CrashAfterWrite(job, 1)

    def start():
        stream = spark.readStream.option("maxFilesPerTrigger", 1).text(stage)
        return (stream.writeStream.foreachBatch(crashing).option("checkpointLocation", ck)
                .trigger(availableNow=True).start())

    with _pytest.raises(Exception):
        run_to_end(start(), 300)
    assert crashing.crashed
    run_to_end(start(), 300)       # restart: batch 1 runs again, then the rest
    batch = {(r["metric"], r["key"]): r["income"]
             for r in metrics_one_pass(lines_with_province(parse_order_lines(log), rules)).collect()}
    streamed = {(r["metric"], r["key"]): r["income"] for r in order_totals(spark, ledger, "crash").collect()}
    assert streamed == batch


RECORDS = "topic string, partition int, offset bigint, key string, value string"


def _record_run(spark, tmp_path, job, name, rows, fail_at=None):
    """One streaming run with a checkpoint of its own over ``rows``."""
    src = str(tmp_path / f"src-{name}")
    spark.createDataFrame(rows, RECORDS).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(RECORDS).parquet(src)
    run_to_end(start_order_metrics(stream, job, str(tmp_path / f"ck-{name}"), "available_now"), 300)


def test_resume_with_a_new_checkpoint_loses_nothing(spark, tmp_path):
    metrics, offsets = str(tmp_path / "m"), str(tmp_path / "o")
    job = OrderMetricsBatch(_sf_rules(spark), metrics, "q", offset_ledger=offsets, group_id="g")
    _record_run(spark, tmp_path, job, "one", [("t", 0, 0, None, "A 16.0.0.1 c i 10"), ("t", 0, 1, None, "A 16.0.0.1 c i 20"),
                                              ("t", 1, 0, None, "A 16.0.0.1 d i 5")])
    _record_run(spark, tmp_path, job, "two", [("t", 0, 2, None, "A 16.0.0.1 c i 100")])
    totals = {(r["metric"], r["key"]): r["income"] for r in order_totals(spark, metrics, "q", offsets, "g").collect()}
    assert totals[("total", "TOTAL_INCOME")] == 135.0 and totals[("category", "c")] == 130.0
    assert {(r["topic"], r["partitioner"]): r["offset"] for r in stored_offsets(spark, offsets, "g").collect()} == {
        ("t", 0): 3, ("t", 1): 1}


def test_crash_between_deltas_and_offsets_counts_once(spark, tmp_path):
    import pytest as _pytest
    metrics, offsets = str(tmp_path / "m"), str(tmp_path / "o")
    job = OrderMetricsBatch(_sf_rules(spark), metrics, "q", offset_ledger=offsets, group_id="g")
    rows = [("t", 0, 0, None, "A 16.0.0.1 c i 10")]
    write = job.offsets.write

    def crash(*args):
        raise RuntimeError("crash before the offsets are stored")

    object.__setattr__(job.offsets, "write", crash)
    with _pytest.raises(Exception, match="crash"):
        _record_run(spark, tmp_path, job, "one", rows)
    object.__setattr__(job.offsets, "write", write)
    assert order_totals(spark, metrics, "q", offsets, "g").count() == 0
    _record_run(spark, tmp_path, job, "two", rows)  # a resume from the offsets reads the record again
    totals = {r["metric"]: r["income"] for r in order_totals(spark, metrics, "q", offsets, "g").collect()}
    assert totals["total"] == 10.0


def test_folding_keeps_totals_and_bounds_the_folders(spark, tmp_path):
    from eddyflow.streaming import metric_ledger, offset_ledger
    metrics, offsets = str(tmp_path / "m"), str(tmp_path / "o")
    job = OrderMetricsBatch(_sf_rules(spark), metrics, "q", offset_ledger=offsets, group_id="g", fold_every=5)
    most = 0
    for i in range(50):
        job(spark.createDataFrame([("t", i % 2, i, None, f"A 16.0.0.1 c i {i}")], RECORDS), i)
        most = max(most, len(os.listdir(f"{metrics}/query=q/run=direct")), len(os.listdir(f"{offsets}/groupid=g/run=direct")))
    assert most <= 11
    assert len(os.listdir(f"{metrics}/_base/q")) <= 2
    for _ in range(2):
        totals = {r["metric"]: r["income"] for r in order_totals(spark, metrics, "q", offsets, "g").collect()}
        assert totals["total"] == sum(range(50))
        assert {r["partitioner"]: r["offset"] for r in stored_offsets(spark, offsets, "g").collect()} == {0: 49, 1: 50}
        metric_ledger(metrics).fold(spark, "q", "direct", 49)
        offset_ledger(offsets).fold(spark, "g", "direct", 49)


def test_an_unfinished_base_is_ignored(spark, tmp_path):
    from eddyflow.streaming import metric_ledger
    ledger = metric_ledger(str(tmp_path / "m"))
    rows = exact_parts(spark.createDataFrame([("total", "T", 1)], "metric string, key string, delta int"),
                       ["metric", "key"], "delta")
    for i in range(3):
        ledger.write(rows, "q", "r", i)
    ledger.fold(spark, "q", "r", 1)
    os.makedirs(f"{ledger.path}/_base/q/v=1/rows")  # a fold that died before its last file
    assert [r["income"] for r in running_totals(ledger.read(spark, "q")).collect()] == [3.0]
    ledger.fold(spark, "q", "r", 2)
    assert [r["income"] for r in running_totals(ledger.read(spark, "q")).collect()] == [3.0]


def test_running_counts_of_two_checkpoints_add_up(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    _write_text(src, "b1.txt", ["a b", "a"])
    for ck in ("ck1", "ck2"):
        run_to_end(start_running_word_count(spark.readStream.text(src), out, str(tmp_path / ck), "value",
                                            "available_now", state_partitions=2), 120)
    assert {r["word"]: r["cnt"] for r in running_counts(spark, out).collect()} == {"a": 4, "b": 2}


def test_full_print_runs_on_the_executors(spark, tmp_path):
    from eddyflow.operators import word_count
    from eddyflow.sinks import full_print_writer
    src = str(tmp_path / "src")
    _write_text(src, "a.txt", ["x y", "y"])
    q = (full_print_writer(word_count(spark.readStream.text(src), "value"))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    run_to_end(q, 120)


def test_tables_stream_from_files_and_folders(spark, tmp_path):
    from eddyflow.streaming import stream_table
    for n in (1, 3):
        spark.range(30).repartition(n).write.parquet(str(tmp_path / f"d{n}" / "t.parquet"))
    spark.range(30).coalesce(1).write.parquet(str(tmp_path / "x"))
    os.makedirs(tmp_path / "f")
    part = next(p for p in os.listdir(tmp_path / "x") if p.startswith("part-"))
    os.link(tmp_path / "x" / part, tmp_path / "f" / "t.parquet")
    for d in ("d1", "d3", "f"):
        seen = []
        q = (stream_table(spark, str(tmp_path / d), "t").writeStream
             .foreachBatch(lambda b, i: seen.append(b.count())).option("checkpointLocation", str(tmp_path / f"ck-{d}"))
             .trigger(availableNow=True).start())
        run_to_end(q, 120)
        assert sum(seen) == 30


def test_permissive_stream_survives_any_line(spark, tmp_path):
    """Wide prices are summed, unreadable ones put aside; no line stops the stream."""
    src, ledger, rejects = (str(tmp_path / d) for d in ("src", "m", "r"))
    _write_text(src, "a.txt", ["A 16.0.0.1 c i 0.123456789", "A 16.0.0.1 d i 1e30", "A 16.0.0.1 e i NaN",
                               "A 16.0.0.1 f i Infinity", "A 16.0.0.1 g i 1e-300", "A 16.0.0.1 c i 1,5", "x", "",
                               "A 16.0.0.1 c i 1e400", "A nowhere c i 1"])
    job = OrderMetricsBatch(_sf_rules(spark), ledger, "q", strict=False, reject_path=rejects)
    run_to_end(start_order_metrics(spark.readStream.text(src), job, str(tmp_path / "ck"), "available_now"), 120)
    got = {r["key"]: r["income"] for r in order_totals(spark, ledger, "q").collect() if r["metric"] == "category"}
    assert repr(got["e"]) == "nan" and {k: v for k, v in got.items() if k != "e"} == {
        "c": float("inf"), "d": 1e30, "f": float("inf"), "g": 1e-300}
    assert spark.read.parquet(rejects).count() == 4


def test_registered_streams_run_several_batches(spark):
    """State is updated, ledgers added to and folded: more than one batch each."""
    from eddyflow.plans.queries import QUERIES
    from pyspark.sql.streaming import StreamingQueryListener
    rows = {}

    class Batches(StreamingQueryListener):
        def onQueryStarted(self, event): pass
        def onQueryIdle(self, event): pass
        def onQueryTerminated(self, event): pass
        def onQueryProgress(self, event):
            if event.progress.numInputRows:
                rows.setdefault(str(event.progress.id), []).append(event.progress.batchId)

    listener = Batches()
    spark.streams.addListener(listener)
    try:
        for name in ("word_count_running", "offset_ledger_latest"):
            rows.clear()
            QUERIES[name](spark, SF)
            deadline = time.time() + 20
            while (not rows or max(map(len, rows.values())) < 3) and time.time() < deadline:
                time.sleep(0.2)
            assert any(len(b) >= 3 for b in rows.values()), (name, rows)
    finally:
        spark.streams.removeListener(listener)


def test_offsets_and_deltas_come_from_one_read_and_nothing_is_cached(spark, tmp_path):
    metrics, offsets = str(tmp_path / "m"), str(tmp_path / "o")
    job = OrderMetricsBatch(_sf_rules(spark), metrics, "q", offset_ledger=offsets, group_id="g")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = [("a/b", i % 3, i, None, f"A 16.0.0.1 c{i % 2} i {i}") for i in range(90)]
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    job(spark.createDataFrame(rows, RECORDS).mapInArrow(counted, RECORDS), 0)
    assert read.value == 90
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == held
    assert {(r["topic"], r["partitioner"]): r["offset"] for r in stored_offsets(spark, offsets, "g").collect()} == {
        ("a/b", 0): 88, ("a/b", 1): 89, ("a/b", 2): 90}
    totals = {(r["metric"], r["key"]): r["income"] for r in order_totals(spark, metrics, "q", offsets, "g").collect()}
    assert totals[("total", "TOTAL_INCOME")] == sum(range(90)) and totals[("category", "c0")] == sum(range(0, 90, 2))
    assert len(totals) == 4


def test_malformed_lines_count_as_consumed_only(spark, tmp_path):
    metrics, offsets, rejects = (str(tmp_path / d) for d in "mor")
    job = OrderMetricsBatch(_sf_rules(spark), metrics, "q", offset_ledger=offsets, group_id="g", strict=False,
                            reject_path=rejects)
    job(spark.createDataFrame([("t", 0, 4, None, "A 16.0.0.1 c i 10"), ("t", 0, 9, None, "A x.y c i 7"),
                               ("t", 1, 3, None, None), ("t", 2, 0, None, "A 16.0.0.1 d i"),
                               (None, None, 6, None, "A 16.0.0.1 c i 1")], RECORDS), 0)
    assert {(r["topic"], r["partitioner"]): r["offset"] for r in stored_offsets(spark, offsets, "g").collect()
            if r["topic"]} == {("t", 0): 10, ("t", 1): 4, ("t", 2): 1}
    totals = {(r["metric"], r["key"]): r["income"] for r in order_totals(spark, metrics, "q", offsets, "g").collect()}
    assert totals[("total", "TOTAL_INCOME")] == 11.0 and ("category", "d") not in totals
    assert spark.read.parquet(rejects).count() == 3
