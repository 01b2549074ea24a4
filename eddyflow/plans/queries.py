"""The registered queries: each reads the driver's tables under ``sf_dir`` and
returns a DataFrame (nothing is collected).  Streaming queries read the tables
where they lie (only the order text, which a join makes, is written first), keep
their ledgers under the shared checkpoint folder, and run to the end of their
input before the result table is returned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ip import ip_to_number
from ..functions.orderline import parse_order_lines, split_rejects
from ..operators.income import (income_by_category, income_by_province, metric_deltas,
                                metrics_one_pass, total_income)
from ..operators.metrics import flat_view
from ..operators.offsets import batch_offsets, latest_offsets, unconsumed
from ..operators.rangejoin import RangeTable, prepare_ranges, range_lookup
from ..operators.ranking import with_global_position
from ..operators.wordcount import sorted_word_count, top_words, word_count
from ..session import default_parallelism, shared_path
from ..sinks.console import record_lines
from ..sinks.tables import append_table
from ..sources.messages import messages_for_rows
from ..sources.orderlog import buyer_ip, order_log_from_tables, wide_order_log
from ..sources.recordlog import resumed, write_record_log
from ..sources.records import EVENT_PARTITIONS, RECORD_SCHEMA, records_from_events, records_from_order_log
from ..sources.rules import parse_rule_lines, rule_lines_from_nations
from ..sources.tables import read_table
from ..streaming.ledger import metric_ledger, offset_ledger, per_batch_ledger
from ..streaming.offsets import start_offset_ledger
from ..streaming.orders import (OrderMetricsBatch, lines_with_province, order_totals, start_order_metrics,
                                stored_offsets)
from ..streaming.runner import run_to_end
from ..streaming.state import start_running_state, stored_state
from ..streaming.staging import stream_folder, stream_lines, stream_table
from ..streaming.wordcount import (per_key_counts, running_counts, start_per_batch_word_count,
                                   start_running_word_count)

QueryFn = Callable[[SparkSession, str], DataFrame]

# Consumer group under which the event record log is tracked.
EVENTS_GROUP = "eddy-events"
# Segments of a partition of the order log, as the registered queries lay it out.
LOG_SEGMENTS = 8
# Registered streams fold their ledgers after this many batches.
FOLD_EVERY = 2
# The user-given state update stops counting a word here.
STATE_CAP = 100
# Words are looked up in the store by this prefix.
STORE_PREFIX = "st"
# Job names in the ledgers.
ORDERS = "orders"
WORDS = "words"


# ---------------------------------------------------------------- inputs

def ip_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``start_num, end_num, province`` parsed from rule lines built from the
    nation and region tables."""
    lines = rule_lines_from_nations(read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey"),
                                    read_table(spark, sf_dir, "region", "r_regionkey", "r_name"))
    return parse_rule_lines(lines)


def rule_table(spark: SparkSession, sf_dir: str, persist: bool = False) -> RangeTable:
    return prepare_ranges(ip_rules(spark, sf_dir), persist=persist)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_order_lines(order_log_from_tables(spark, sf_dir))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_from_events(read_table(spark, sf_dir, "events"))


# ---------------------------------------------------------- word counts

def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(read_table(spark, sf_dir, "documents", "text", spread=True))


def q_word_count_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_words(word_count(read_table(spark, sf_dir, "documents", "text", spread=True)), 10)


def q_word_count_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_word_count(word_count(read_table(spark, sf_dir, "documents", "text", spread=True)))


def q_word_count_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts appended to the ``access_log`` table (Parquet in the shared
    folder; ``sinks.jdbc`` writes the same rows to a SQL table) and read back."""
    path = shared_path(spark, "access_log")
    append_table(word_count(read_table(spark, sf_dir, "benchmark", "text")).select("word", "cnt"), path)
    return spark.read.schema("word string, cnt bigint").parquet(path)


def q_word_count_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns are the arrival batches: turn k of every
    conversation belongs to batch k, counted on its own.  One stream reads the
    table; each micro-batch counts per (turn, word) and the partials of a turn
    are added up, so batch k's counts hold exactly turn k's words.
    ``batch_id`` numbers the turns in arrival order."""
    base = shared_path(spark, "per_batch")
    stream = stream_table(spark, sf_dir, "conversations").select(
        F.col("turn").cast("bigint").alias("turn"), F.col("text").alias("value"))
    run_to_end(start_per_batch_word_count(stream, f"{base}/out", f"{base}/ckpt", "value", "available_now",
                                          keys=("turn",), fold_every=FOLD_EVERY))
    counts = per_key_counts(spark, f"{base}/out", "turn bigint")
    order = with_global_position(counts.select("turn").distinct(), [F.col("turn")])
    return counts.join(order, "turn").select((F.col("position") - 1).cast("bigint").alias("batch_id"), "word", "cnt")


def q_word_count_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations read as a stream into a stateful running count; the totals
    after the last batch."""
    base = shared_path(spark, "running")
    stream = stream_table(spark, sf_dir, "conversations").select(F.col("text").alias("value"))
    run_to_end(start_running_word_count(stream, f"{base}/out", f"{base}/ckpt", "value", "available_now",
                                        state_partitions=default_parallelism(spark), fold_every=FOLD_EVERY))
    return running_counts(spark, f"{base}/out")


def q_word_state_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running state with an update function of its own: words are counted up to
    ``STATE_CAP`` and no further in the benchmark texts, starting from those of the
    part names.
    The state is read back from the checkpoint."""
    cap = STATE_CAP

    def capped(word: str, n: int, old: dict | None) -> dict:
        return {"cnt": min(cap, n + (old["cnt"] if old else 0))}

    checkpoint = f"{shared_path(spark, 'state')}/ckpt"
    start = word_count(read_table(spark, sf_dir, "part", "p_name"), "p_name").select(
        "word", F.least("cnt", F.lit(cap)).alias("cnt"))
    stream = stream_table(spark, sf_dir, "benchmark").select(F.col("text").alias("value"))
    run_to_end(start_running_state(stream, capped, "cnt bigint", lambda batch, i: batch.foreachPartition(lambda rows: None),
                                   checkpoint, trigger="available_now", state_partitions=default_parallelism(spark),
                                   initial=start))
    return stored_state(spark, checkpoint)


def q_word_store_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of three tables stored as three batches, two of them folded; the words
    of one prefix read back from the sorted parts and the batch beside them."""
    ledger = per_batch_ledger(shared_path(spark, "word_store"))
    for batch_id, table in enumerate(("documents", "conversations", "benchmark")):
        ledger.write(word_count(read_table(spark, sf_dir, table, "text", spread=True)), WORDS, "direct", batch_id)
        if batch_id < 2:
            ledger.fold(spark, WORDS, "direct", batch_id)
    return ledger.find(spark, WORDS, F.col("word").startswith(STORE_PREFIX))


# ------------------------------------------------------------ order lines

def q_order_lines_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(spark, sf_dir)


def q_order_total_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_income(order_lines(spark, sf_dir))


def q_order_income_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return income_by_category(order_lines(spark, sf_dir))


def q_order_income_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Income per part size of prices over the whole range of doubles: each size
    moves its prices by 40 bits, from 2^-960 to 2^880; sizes 48 to 50 hold infinities
    of both signs, of one sign, and a NaN.  Lines that are no order lines go aside."""
    prices = wide_order_log(spark, sf_dir)
    good, _ = split_rejects(parse_order_lines(prices, strict=False))
    return income_by_category(good)


def q_order_income_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return income_by_province(lines_with_province(order_lines(spark, sf_dir), rule_table(spark, sf_dir)))


def q_order_metrics_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics_one_pass(lines_with_province(order_lines(spark, sf_dir), rule_table(spark, sf_dir)))


def q_order_running_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order log as a text stream into the delta ledger, folded once at the
    end; totals over the ledger."""
    base = shared_path(spark, "orders")
    stream = stream_lines(spark, order_log_from_tables(spark, sf_dir), f"{base}/log")
    rules = rule_table(spark, sf_dir, persist=True)
    job = OrderMetricsBatch(rules, f"{base}/ledger", query=ORDERS, fold_every=FOLD_EVERY)
    try:
        query = run_to_end(start_order_metrics(stream, job, f"{base}/ckpt", "available_now"))
    finally:
        rules.release()
    if query.lastProgress:
        metric_ledger(f"{base}/ledger").fold(spark, ORDERS, str(query.id), query.lastProgress["batchId"])
    return order_totals(spark, f"{base}/ledger", ORDERS)


def q_order_resume_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record job that stops and is resumed from its stored offsets with a new
    checkpoint.  The log lies in segments; the first run sees the first half of
    every partition but the last one, which it does not see at all; the second run
    opens only the segments that the ledger does not cover.  Totals of the metrics,
    and per partition the offset to go on from."""
    base = shared_path(spark, "resume")
    log, metrics, offsets = f"{base}/log", f"{base}/metrics", f"{base}/offsets"
    records = records_from_order_log(order_log_from_tables(spark, sf_dir, keep=("l_orderkey", "l_linenumber")))
    keys = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber").agg(
        F.max(F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("end")).first()
    last = keys["end"] or 0
    segment = max(1, last // LOG_SEGMENTS)
    write_record_log(records, log, segment)
    rules = rule_table(spark, sf_dir, persist=True)
    job = OrderMetricsBatch(rules, metrics, ORDERS, offset_ledger=offsets, group_id=ORDERS, fold_every=FOLD_EVERY)

    def run(name: str, wanted: Callable[[DataFrame], DataFrame]) -> None:
        stream = stream_folder(spark, log, f"{RECORD_SCHEMA}, segment bigint")
        run_to_end(start_order_metrics(wanted(stream), job, f"{base}/{name}", "available_now"))

    try:
        run("first", lambda s: s.where((F.col("segment") <= last // 2 // segment) & (F.col("offset") < last // 2)
                                       & (F.col("partition") < EVENT_PARTITIONS - 1)).drop("segment"))
        run("second", lambda s: resumed(s, stored_offsets(spark, offsets, ORDERS), segment))
    finally:
        rules.release()
    totals = order_totals(spark, metrics, ORDERS, offsets, ORDERS).select("metric", "key", F.col("income").alias("value"))
    ends = stored_offsets(spark, offsets, ORDERS).select(
        F.lit("offset").alias("metric"), F.concat_ws("/", "topic", F.col("partitioner").cast("string")).alias("key"),
        F.col("offset").cast("double").alias("value"))
    return totals.unionByName(ends)


def q_metric_store_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics stored as deltas, read back as the flat key space."""
    ledger = metric_ledger(shared_path(spark, "metric_store"))
    ledger.write(metric_deltas(lines_with_province(order_lines(spark, sf_dir), rule_table(spark, sf_dir))),
                 ORDERS, "direct", 0)
    return flat_view(ledger.read(spark))


# ------------------------------------------------------------- IP lookups

def q_ip_to_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer", "c_custkey")
    return (cust.select("c_custkey", buyer_ip(F.col("c_custkey")).alias("ip"))
            .withColumn("ip_num", ip_to_number(F.col("ip"))))


def q_ip_zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer", "c_custkey").select(
        "c_custkey", buyer_ip(F.col("c_custkey")).alias("ip"))
    zoned = range_lookup(cust, ip_to_number(F.col("ip")), rule_table(spark, sf_dir), how="left")
    return zoned.select("c_custkey", "ip", F.coalesce(F.col("province"), F.lit("")).alias("province"))


def q_ip_wide_zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup moved up by 30 bits: rules wider than any bucket table, so
    they are swept."""
    cust = read_table(spark, sf_dir, "customer", "c_custkey").select(
        "c_custkey", buyer_ip(F.col("c_custkey")).alias("ip"))
    number = F.shiftleft(ip_to_number(F.col("ip")), 30)
    rules = ip_rules(spark, sf_dir).select(
        F.shiftleft("start_num", 30).alias("start_num"),
        (F.shiftleft(F.col("end_num") + 1, 30) - 1).alias("end_num"), "province")
    zoned = range_lookup(cust.withColumn("number", number), F.col("number"), prepare_ranges(rules), how="left")
    return zoned.select("c_custkey", "number", F.coalesce("province", F.lit("")).alias("province"))


def q_ip_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier address looked up on its own: only addresses a rule
    holds get a province (the single-address lookup has no default)."""
    supp = read_table(spark, sf_dir, "supplier", "s_suppkey").select(
        "s_suppkey", buyer_ip(F.col("s_suppkey")).alias("ip"))
    found = range_lookup(supp, ip_to_number(F.col("ip")), rule_table(spark, sf_dir), how="inner")
    return found.select("s_suppkey", "ip", "province")


# ---------------------------------------------------------------- offsets

def q_offset_ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event record log consumed by a stream; each batch appends its ledger
    rows; latest end per partition."""
    base = shared_path(spark, "offsets")
    stream = records_from_events(stream_table(spark, sf_dir, "events"))
    run_to_end(start_offset_ledger(stream, f"{base}/ledger", EVENTS_GROUP, f"{base}/ckpt", "available_now",
                                   fold_every=FOLD_EVERY))
    return stored_offsets(spark, f"{base}/ledger", EVENTS_GROUP).select("groupid", "topic", "partitioner", "offset")


def _first_half_cut(records: DataFrame):
    """Midpoint of the record time range, as a scalar subquery."""
    span = records.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
    return span.select(F.timestamp_add(
        "MICROSECOND", F.shiftright(F.timestamp_diff("MICROSECOND", F.col("lo"), F.col("hi")), 1),
        F.col("lo"))).scalar()


def q_offset_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer stored its offsets after reading the first half of the time
    range, all partitions but number 0; resuming yields every record at or after
    the stored ends, and partition 0 from its start."""
    ledger = offset_ledger(shared_path(spark, "resume_ledger"))
    records = event_records(spark, sf_dir)
    consumed = records.where((F.col("timestamp") < _first_half_cut(records)) & (F.col("partition") != 0))
    ledger.write(batch_offsets(consumed, EVENTS_GROUP), EVENTS_GROUP, "direct", 0)
    latest = latest_offsets(ledger.read(spark, EVENTS_GROUP), EVENTS_GROUP)
    return unconsumed(records, latest).select("topic", "partition", "offset", "key", "value")


# -------------------------------------------------------- records, messages

def q_kafka_record_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the event log as the consumer prints it."""
    return record_lines(event_records(spark, sf_dir), keep=("topic", "partition"))


def q_message_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered messages, one per event, numbered from 1000."""
    return messages_for_rows(read_table(spark, sf_dir, "events", "event_id"), "event_id", 1000)


QUERIES: dict[str, QueryFn] = {
    "word_count": q_word_count,
    "word_count_per_batch": q_word_count_per_batch,
    "word_count_running": q_word_count_running,
    "word_state_capped": q_word_state_capped,
    "word_count_sorted": q_word_count_sorted,
    "word_count_top10": q_word_count_top10,
    "word_count_store": q_word_count_store,
    "word_store_lookup": q_word_store_lookup,
    "order_lines_parsed": q_order_lines_parsed,
    "order_total_income": q_order_total_income,
    "order_income_by_category": q_order_income_by_category,
    "order_income_wide": q_order_income_wide,
    "order_income_by_zone": q_order_income_by_zone,
    "order_metrics_one_pass": q_order_metrics_one_pass,
    "order_running_metrics": q_order_running_metrics,
    "order_resume_totals": q_order_resume_totals,
    "metric_store_scan": q_metric_store_scan,
    "ip_to_number": q_ip_to_number,
    "ip_zone_lookup": q_ip_zone_lookup,
    "ip_wide_zone_lookup": q_ip_wide_zone_lookup,
    "ip_point_lookup": q_ip_point_lookup,
    "offset_ledger_latest": q_offset_ledger_latest,
    "offset_resume": q_offset_resume,
    "kafka_record_tail": q_kafka_record_tail,
    "message_range": q_message_range,
}
