"""Where messages come from and go to.

Kafka needs the ``spark-sql-kafka`` package on the cluster. The file endpoints carry the same
``value`` column and stand in for a topic where there is no broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwork.streaming.messages import to_messages


def kafka_source_options(
    servers: str, topic: str, starting_offsets: str = "earliest", max_per_trigger: int | None = None
) -> dict[str, str]:
    """Reader options for one topic; ``max_per_trigger`` bounds the rows of a micro-batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    """Writer options for one topic."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Stream of a Kafka topic; ``options`` as in ``kafka_source_options``."""
    return (
        spark.readStream.format("kafka")
        .options(**kafka_source_options(servers, topic, **options))
        .load()
    )


def publish_to_kafka(df: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    """Send each row as one JSON message, straight from the executors.

    Delivery is at least once: running it again sends every row again, and a task repeated after a
    lost executor sends its rows again.
    """
    messages = to_messages(df, key)
    messages.write.format("kafka").options(**kafka_sink_options(servers, topic)).save()


def file_topic_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of a folder of text files, one message per line, also of the folders of runs in it; new
    files are picked up once."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def publish_to_files(df: DataFrame, path: str) -> None:
    """Append each row as one JSON message to a folder ``file_topic_stream`` can follow."""
    to_messages(df).write.mode("append").text(path)
