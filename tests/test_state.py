"""Stateful streams and the producer's ledger: copies, late rows, restarts, interrupted runs."""

import pytest
from pyspark.sql import functions as F

from tillwork.streaming.ledger import publish_once, to_files
from tillwork.streaming.state import daily_distinct, drain_to_parquet, keep_state_on_disk, once_each

SCHEMA = "key string, at timestamp, note string"


class Stream:
    """A folder of JSON files followed as a stream, with the output and state of one query."""

    def __init__(self, spark, root):
        self.spark, self.source = keep_state_on_disk(spark), str(root / "in")
        self.out, self.state = str(root / "out"), str(root / "state")

    def deliver(self, *rows):
        named = self.spark.createDataFrame(rows, "key string, at string, note string")
        named.coalesce(1).write.mode("append").json(self.source)

    def drain(self, shape):
        return drain_to_parquet(
            shape(self.spark.readStream.schema(SCHEMA).json(self.source)), self.out, self.state
        )

    def stored(self, schema=SCHEMA):
        return sorted((tuple(r) for r in self.spark.read.schema(schema).parquet(self.out).collect()), key=str)


@pytest.fixture
def stream(spark, tmp_path):
    return Stream(spark, tmp_path)


def test_copies_meet_over_batches_and_restarts(stream):
    def shape(rows):
        return once_each(rows, "at", "1 hour", ["key"])

    stream.deliver(("a", "2024-01-01 10:00:00", "1"), ("a", "2024-01-01 10:01:00", "2"), (None, "2024-01-01 10:00:00", "n"))
    assert stream.drain(shape).late == 0
    stream.deliver(
        ("a", "2024-01-01 10:30:00", "3"),
        ("b", "2024-01-01 10:30:00", "1"),
        ("c", "2024-01-01 08:00:00", "late"),
        ("d", None, "no time"),
        (None, "2024-01-01 10:05:00", "n"),
    )
    second = stream.drain(shape)
    assert (second.rows, second.late) == (5, 1)
    # The state of "a" has gone by now, so it counts as new.
    stream.deliver(("x", "2024-01-01 14:00:00", "1"))
    stream.drain(shape)
    stream.deliver(("a", "2024-01-01 14:01:00", "4"), ("x", "2024-01-01 14:30:00", "2"))
    assert stream.drain(shape).late == 0
    keys = [row[0] for row in stream.stored()]
    assert sorted(keys, key=str) == sorted([None, "a", "a", "b", "d", "x"], key=str)


def test_whole_rows_identify_without_keys(stream):
    def shape(rows):
        return once_each(rows, "at", "1 hour")

    row = ("a", "2024-01-01 10:00:00", None)
    stream.deliver(row, row, ("a", "2024-01-01 10:00:00", "x"))
    stream.drain(shape)
    stream.deliver(row)
    stream.drain(shape)
    assert len(stream.stored()) == 2


def test_days_close_and_late_rows_are_counted(stream):
    def shape(rows):
        return daily_distinct(rows, "at", "key", "6 hours")

    stream.deliver(("a", "2024-01-01 10:00:00", ""), ("a", "2024-01-01 11:00:00", ""), ("b", "2024-01-01 23:00:00", ""))
    assert stream.drain(shape).late == 0
    stream.deliver(("a", "2024-01-01 22:00:00", ""), ("c", "2024-01-02 05:00:00", ""), (None, "2024-01-02 05:00:00", ""))
    assert stream.drain(shape).late == 0
    stream.deliver(("a", "2024-01-02 07:00:00", ""), ("d", "2024-01-03 09:00:00", ""))
    stream.drain(shape)
    stream.deliver(("z", "2024-01-01 10:00:00", ""), ("e", "2024-01-03 09:00:00", ""))
    assert stream.drain(shape).late == 1
    days = [(str(day), n) for day, n in stream.stored("Day date, num_orders long")]
    assert days == [("2024-01-01", 2), ("2024-01-02", 2)]


class Topic:
    def __init__(self, spark, root):
        self.spark, self.ledger, self.path = spark, str(root / "ledger"), str(root / "topic")
        self.send = to_files(self.path)

    def publish(self, *texts, send=None):
        rows = self.spark.createDataFrame([(t,) for t in texts], "name string")
        return publish_once(rows, self.ledger, send or self.send)

    def sent(self):
        read = self.spark.read.option("recursiveFileLookup", "true").text(self.path)
        return sorted(row.value for row in read.collect())


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


def test_second_run_sends_nothing(topic):
    assert topic.publish("a", "b", "b", None) == 3
    assert topic.publish("a", "b", None) == 0
    assert topic.publish("b", "c") == 1
    assert topic.sent() == ['{"name":"a"}', '{"name":"b"}', '{"name":"c"}', "{}"]


def test_interrupted_run_is_sent_by_the_next(topic):
    def fails(messages, run):
        raise RuntimeError("no broker")

    def sends_and_fails(messages, run):
        topic.send(messages, run)
        raise RuntimeError("lost after sending")

    for broken in (fails, sends_and_fails):
        with pytest.raises(RuntimeError):
            topic.publish("a", "b", send=broken)
    assert topic.publish("a", "b") == 0
    assert topic.sent() == ['{"name":"a"}', '{"name":"b"}']


def test_kafka_gets_the_digest_as_key(topic, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from tillwork.streaming import ledger

    seen = {}
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: seen.update(rows=self._df.collect()))
    topic.publish("a", send=ledger.to_kafka("host:1", "t"))
    (row,) = seen["rows"]
    assert row.value == '{"name":"a"}' and len(row.key) == 64


def test_time_must_be_a_timestamp(spark, tmp_path):
    rows = spark.readStream.schema("at string").json(str(tmp_path))
    with pytest.raises(Exception, match="(?i)timestamp"):
        once_each(rows.withColumn("at", F.col("at")), "at", "1 hour")
