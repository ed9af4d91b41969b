"""Messages and the feed, over files in place of a broker."""

import json
import time

import pytest

from tillwork.plans.feed import drain_feed, start_feed
from tillwork.schemas import all_strings
from tillwork.sources.files import read_json
from tillwork.streaming.endpoints import (
    file_topic_stream,
    kafka_sink_options,
    kafka_source_options,
    kafka_stream,
    publish_to_files,
    publish_to_kafka,
)
from tillwork.streaming.messages import (
    parse_messages,
    parse_or_quarantine,
    raw_messages,
    to_messages,
)

SCHEMA = all_strings(["id", "name"])
MESSAGES = [
    '{"id":"1","name":"Ann"}',
    '{"id":"2"}',
    '{"id":"3","name":"Lee","extra":1}',
    "{bad",
    "",
    None,
]


def messages(spark, texts=MESSAGES):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


class Feed:
    """A file topic with the feed's output and checkpoint folders."""

    def __init__(self, spark, root):
        self.spark = spark
        self.topic, self.out, self.checkpoint = (str(root / n) for n in ("topic", "out", "ckpt"))

    def publish(self, *records):
        publish_to_files(self.spark.createDataFrame(records, "id string, name string"), self.topic)

    def publish_text(self, *texts):
        messages(self.spark, texts).write.mode("append").text(self.topic)

    def drain(self, **options):
        stream = file_topic_stream(self.spark, self.topic)
        drain_feed(stream, SCHEMA, self.out, self.checkpoint, **options)

    def stored(self, schema=SCHEMA):
        return rows(read_json(self.spark, self.out, schema, multi_line=False))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_messages_are_json_objects_without_nulls(spark):
    df = spark.createDataFrame([(1, None, "é\n")], "a int, b string, c string")
    message = to_messages(df).collect()[0]
    assert message.value == df.toJSON().collect()[0] == '{"a":1,"c":"é\\n"}'
    assert json.loads(message.value) == {"a": 1, "c": "é\n"}
    keyed = to_messages(df, key="a").collect()[0]
    assert (keyed.key, keyed.value) == ("1", message.value)


def test_parse(spark):
    expected = [("1", "Ann"), ("2", None), ("3", "Lee"), (None, None), (None, None), (None, None)]
    assert rows(parse_messages(messages(spark), SCHEMA)) == sorted(expected, key=str)
    binary = messages(spark).selectExpr("cast(value AS binary) AS value")
    assert rows(parse_messages(binary, SCHEMA)) == sorted(expected, key=str)
    assert rows(raw_messages(binary)) == rows(messages(spark))


def test_round_trip(spark):
    df = spark.createDataFrame([("1", "Ann"), ("2", None), (None, None)], SCHEMA)
    assert rows(parse_messages(to_messages(df), SCHEMA)) == rows(df)


def test_quarantine(spark):
    got = {
        row.malformed_text: row.malformed
        for row in parse_or_quarantine(messages(spark), SCHEMA).collect()
    }
    assert got == {"{bad": True, "": True, None: False}
    numbers = spark.createDataFrame([], "id int, name string").schema
    misfit = parse_or_quarantine(messages(spark, ['{"id":"x","name":"Ann"}']), numbers).collect()
    assert [tuple(row) for row in misfit] == [(None, "Ann", '{"id":"x","name":"Ann"}', True)]


def test_feed_stores_each_message_once(feed):
    feed.publish(("1", "Ann"), ("2", None))
    feed.drain()
    assert feed.stored() == [("1", "Ann"), ("2", None)]
    feed.drain()
    assert feed.stored() == [("1", "Ann"), ("2", None)]
    feed.publish(("3", "Lee"))
    feed.drain()
    assert feed.stored() == [("1", "Ann"), ("2", None), ("3", "Lee")]


def test_feed_equals_batch_parse(spark, feed):
    feed.publish_text(*[text for text in MESSAGES if text is not None])
    feed.drain()
    batch = parse_messages(spark.read.text(feed.topic), SCHEMA)
    assert feed.stored() == rows(batch)


def test_feed_keeps_raw_text(feed):
    feed.publish_text('{"id":"1"}', "{bad")
    feed.drain(parse=False)
    assert feed.stored("value string") == [('{"id":"1"}',), ("{bad",)]


def test_feed_sets_malformed_messages_aside(feed):
    feed.publish_text('{"id":"1","name":"Ann"}', "{bad")
    feed.drain(quarantine=True)
    schema = "id string, name string, malformed_text string, malformed boolean"
    assert feed.stored(schema) == [("1", "Ann", None, False), (None, None, "{bad", True)]


def test_endless_feed_runs_until_stopped(spark, feed):
    feed.publish(("1", "Ann"))
    stream = file_topic_stream(spark, feed.topic, max_files_per_trigger=1)
    query = start_feed(stream, SCHEMA, feed.out, feed.checkpoint)
    try:
        query.processAllAvailable()
        feed.publish(("2", "Lee"))
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert feed.stored() == [("1", "Ann"), ("2", "Lee")]


def test_feed_resumes_after_it_was_stopped_midway(spark, feed):
    expected = []
    for number in range(6):
        feed.publish((str(number), "Ann"))
        expected.append((str(number), "Ann"))
    stream = file_topic_stream(spark, feed.topic, max_files_per_trigger=1)
    query = start_feed(stream, SCHEMA, feed.out, feed.checkpoint)
    try:
        deadline = time.time() + 60
        while not query.recentProgress and time.time() < deadline:
            time.sleep(0.05)
    finally:
        query.stop()
    assert query.recentProgress
    feed.drain()
    assert feed.stored() == expected


def test_kafka_options():
    """Only the options: there is no broker here, so the Kafka path itself is not exercised."""
    assert kafka_source_options("host:9092", "topic") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "topic",
        "startingOffsets": "earliest",
    }
    bounded = kafka_source_options("host:9092", "topic", "latest", 1000)
    assert (bounded["startingOffsets"], bounded["maxOffsetsPerTrigger"]) == ("latest", "1000")
    assert kafka_sink_options("host:9092", "topic") == {
        "kafka.bootstrap.servers": "host:9092",
        "topic": "topic",
    }


class Recorder:
    """Takes any chain of calls and keeps each with its arguments."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


class RecordingSession:
    def __init__(self):
        self.readStream = Recorder()


def test_kafka_stream_asks_for_the_topic():
    session = RecordingSession()
    kafka_stream(session, "host:9092", "topic", max_per_trigger=5)
    assert session.readStream.calls == [
        ("format", ("kafka",), {}),
        ("options", (), kafka_source_options("host:9092", "topic", max_per_trigger=5)),
        ("load", (), {}),
    ]


def test_publishing_reaches_the_kafka_sink(spark, monkeypatch):
    """The messages with their key go to the sink; no connector or broker is needed."""
    rows = spark.createDataFrame([("1",)], "id string")
    writer, sent = Recorder(), []
    write = property(lambda messages: sent.append(messages) or writer)
    monkeypatch.setattr(type(rows), "write", write)
    publish_to_kafka(rows, "host:9092", "topic", key="id")
    assert writer.calls == [
        ("format", ("kafka",), {}),
        ("options", (), kafka_sink_options("host:9092", "topic")),
        ("save", (), {}),
    ]
    assert [(row.key, row.value) for row in sent[0].collect()] == [("1", '{"id":"1"}')]
