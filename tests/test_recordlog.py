"""The segmented record log: a resume opens only what it has not read."""

import pytest
from pyspark.sql import functions as F

from eddyflow.sources.recordlog import read_record_log, resumed, write_record_log
from eddyflow.sources.records import RECORD_SCHEMA
from eddyflow.streaming import run_to_end
from eddyflow.streaming.staging import stream_folder

SEGMENT = 100
SCHEMA = f"{RECORD_SCHEMA}, segment bigint"
LATEST = "groupid string, topic string, partitioner int, offset bigint"


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "log")
    records = spark.range(30_000).select(
        F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"),
        F.floor(F.col("id") / 3).cast("bigint").alias("offset"), F.lit(None).cast("string").alias("key"),
        F.col("id").cast("string").alias("value"), F.lit(None).cast("timestamp").alias("timestamp"))
    write_record_log(records.repartition(7), path, SEGMENT)
    return path


def _files_read(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        sizes = []
        for i in range(leaves.size()):
            metrics = leaves.apply(i).metrics()
            if metrics.contains("numFiles"):
                sizes.append(metrics.apply("numFiles").value())
        return rows, sum(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_resume_near_the_end_opens_one_file_in_a_hundred(spark, log):
    stored = spark.createDataFrame([("g", "t", p, 9_900) for p in range(3)], LATEST)
    whole, files = _files_read(read_record_log(spark, log, SCHEMA))
    assert len(whole) == 30_000 and files >= 300
    rows, opened = _files_read(resumed(read_record_log(spark, log, SCHEMA), stored, SEGMENT))
    assert sorted(r["offset"] for r in rows) == sorted(list(range(9_900, 10_000)) * 3)
    assert opened <= files / 50


def test_offsets_inside_a_segment_and_partitions_without_any(spark, log):
    stored = spark.createDataFrame([("g", "t", 0, 9_955), ("g", "t", 1, 10_000), ("g", "u", 2, 5)], LATEST)
    rows, _ = _files_read(resumed(read_record_log(spark, log, SCHEMA), stored, SEGMENT))
    got = {p: sorted(r["offset"] for r in rows if r["partition"] == p) for p in range(3)}
    assert got == {0: list(range(9_955, 10_000)), 1: [], 2: list(range(10_000))}


def test_nothing_stored_reads_everything(spark, log):
    assert resumed(read_record_log(spark, log, SCHEMA), spark.createDataFrame([], LATEST), SEGMENT).count() == 30_000


def test_a_stream_resumes_by_folders(spark, log, tmp_path):
    stored = spark.createDataFrame([("g", "t", p, 9_850) for p in range(3)], LATEST)
    seen, batches = [], []

    def take(batch, i):
        batches.append(i)
        seen.extend(r["offset"] for r in batch.collect())

    q = (resumed(stream_folder(spark, log, SCHEMA), stored, SEGMENT).writeStream.foreachBatch(take)
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    run_to_end(q, 120)
    assert sorted(seen) == sorted(list(range(9_850, 10_000)) * 3) and len(batches) >= 3


def test_a_record_appended_later_is_read(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = lambda lo, hi: spark.range(lo, hi).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.lit(None).cast("string").alias("key"), F.lit("v").alias("value"), F.lit(None).cast("timestamp").alias("timestamp"))
    write_record_log(rows(0, 150), path, SEGMENT)
    write_record_log(rows(150, 160), path, SEGMENT)
    stored = spark.createDataFrame([("g", "t", 0, 145)], LATEST)
    got = resumed(read_record_log(spark, path, SCHEMA), stored, SEGMENT)
    assert sorted(r["offset"] for r in got.collect()) == list(range(145, 160))


def test_a_log_is_written_from_records_made_once(spark, tmp_path):
    """No sample of the records is drawn before; a segment's files are sorted slices of it."""
    made, path = spark.sparkContext.accumulator(0), str(tmp_path / "log")

    def make(i):
        made.add(1)
        return "t", i % 2, i // 2, None, str(i), None

    write_record_log(spark.createDataFrame(spark.sparkContext.parallelize(range(2000), 4).map(make), RECORD_SCHEMA), path, SEGMENT)
    assert made.value == 2000
    log = read_record_log(spark, path, SCHEMA)
    assert log.count() == 2000 and log.where(F.floor(F.col("offset") / SEGMENT) != F.col("segment")).count() == 0
    files = log.groupBy("partition", "segment", F.input_file_name()).agg(
        F.collect_list("offset").alias("o")).collect()
    assert all(r["o"] == sorted(r["o"]) for r in files) and len(files) <= 9 * 20
