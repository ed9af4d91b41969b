"""Publishing each message once, however often the producer runs.

The ledger is a folder with one Parquet table per run: the digests and texts of the messages that run
sends. A run first stores what no earlier run holds, then sends exactly what it stored, then marks
itself as sent. A run that ended before its mark is sent again by the next one, from what it had
stored. To Kafka that is at least once, with the digest as key for ``once_each`` downstream; to files it
is once, for a run's files appear together and a run that is there is not written again.

One producer at a time may use a ledger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.session import scratch_path
from tillwork.streaming.endpoints import kafka_sink_options
from tillwork.streaming.messages import to_messages

ENTRY = "digest binary, value string"
MARK = "sent"

#: Sends the messages of a run; gets them and the run's name.
Send = Callable[[DataFrame, str], None]


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _runs(spark: SparkSession, ledger: str, suffix: str) -> set[str]:
    files, at = _files(spark, f"{ledger}/run-*/{suffix}")
    return {status.getPath().getParent().getName() for status in files.globStatus(at) or []}


def _entries(spark: SparkSession, ledger: str, runs: set[str]) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(*(f"{ledger}/{run}" for run in sorted(runs)))


def _send(spark: SparkSession, ledger: str, run: str, send: Send) -> None:
    send(_entries(spark, ledger, {run}), run)
    # Beside the run's files: readers of Parquet skip names that begin with an underscore.
    files, at = _files(spark, f"{ledger}/{run}/_{MARK}")
    files.create(at, True).close()


def publish_once(df: DataFrame, ledger: str, send: Send) -> int:
    """Send every row that no earlier run has sent, as one JSON message; returns how many are new.

    Rows are the same if their messages are equal to the last byte; copies within ``df`` count once.
    Only digests are compared, and they are shuffled, not collected.
    """
    spark, ledger = df.sparkSession, ledger.rstrip("/")
    stored = _runs(spark, ledger, "_SUCCESS")
    for run in sorted(stored - _runs(spark, ledger, f"_{MARK}")):
        _send(spark, ledger, run, send)
    messages = to_messages(df).select(F.unhex(F.sha2("value", 256)).alias("digest"), "value")
    new = messages.dropDuplicates(["digest"]).join(
        _entries(spark, ledger, stored).select("digest"), "digest", "left_anti"
    )
    run = scratch_path(spark, "run").rsplit("/", 1)[-1]
    new.write.parquet(f"{ledger}/{run}")
    count = _entries(spark, ledger, {run}).count()
    if count:
        _send(spark, ledger, run, send)
    return count


def to_files(topic: str) -> Send:
    """Send a run into a folder of its own below ``topic``; follow it with ``recursiveFileLookup``."""

    def send(messages: DataFrame, run: str) -> None:
        files, at = _files(messages.sparkSession, f"{topic}/{run}/_SUCCESS")
        if not files.exists(at):
            messages.select("value").write.mode("overwrite").text(f"{topic}/{run}")

    return send


def to_kafka(servers: str, topic: str) -> Send:
    """Send a run to a Kafka topic, the digest as the message key."""

    def send(messages: DataFrame, run: str) -> None:
        keyed = messages.select(F.hex("digest").alias("key"), "value")
        keyed.write.format("kafka").options(**kafka_sink_options(servers, topic)).save()

    return send
