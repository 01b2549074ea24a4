import pytest

from eddyflow.sources import (kafka_options, messages_for_rows, numbered_messages, read_ip_rules,
                              read_kafka_batch, read_kafka_stream, read_socket_stream, records_from_events)


def test_rule_file(spark, tmp_path):
    p = tmp_path / "ip.txt"
    p.write_text("1.0.1.0|1.0.3.255|16777472|16778239|a|b|P1|c\n1.0.8.0|1.0.15.255|16779264|16781311|a|b|P2\n")
    assert [tuple(r) for r in read_ip_rules(spark, str(p)).collect()] == [
        (16777472, 16778239, "P1"), (16779264, 16781311, "P2")]


def test_numbered_messages(spark):
    rows = [r["value"] for r in numbered_messages(spark, 1000, 2000).collect()]
    assert len(rows) == 1000 and rows[0] == "this is message1000" and rows[-1] == "this is message1999"
    rows = [r["value"] for r in numbered_messages(spark, 0, 100, "this is my ", " message").collect()]
    assert rows[0] == "this is my 0 message" and rows[99] == "this is my 99 message"


def test_messages_for_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got = sorted(r["value"] for r in messages_for_rows(df, "event_id").collect())
    assert got == sorted(f"this is message{n}" for n in range(1000, 2000))


def test_records_shape(spark):
    recs = records_from_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    assert [f.name for f in recs.schema.fields] == ["topic", "partition", "offset", "key", "value", "timestamp"]
    assert recs.groupBy("topic", "partition", "offset").count().where("count > 1").count() == 0


def test_kafka_options():
    opts = kafka_options("h:9092", ["a", "b"], "earliest", min_partitions=64, max_offsets_per_trigger=100,
                         **{"failOnDataLoss": "true"})
    assert opts == {"kafka.bootstrap.servers": "h:9092", "subscribe": "a,b", "startingOffsets": "earliest",
                    "minPartitions": "64", "maxOffsetsPerTrigger": "100", "failOnDataLoss": "true"}


def test_kafka_connector_absent_is_reported(spark):
    # The connector jar is not bundled here: the builder fails at load, clearly.
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka_stream(spark, kafka_options("localhost:1", ["t"]))


def test_socket_builder_does_not_connect(spark):
    # Loading a socket source only declares it; nothing connects until start.
    df = read_socket_stream(spark, "localhost", 9)
    assert df.isStreaming and df.columns == ["value"]


def test_bounded_kafka_read_does_not_start_at_the_end(spark):
    with pytest.raises(ValueError, match="latest"):
        read_kafka_batch(spark, kafka_options("localhost:1", ["t"]))


def test_kafka_payload(spark):
    from eddyflow.sinks import kafka_payload
    df = spark.createDataFrame([(1, "x"), (2, None)], "n int, v string")
    assert [tuple(r) for r in kafka_payload(df, "n").collect()] == [("1",), ("2",)]
    assert kafka_payload(df, "v").columns == ["value"]
