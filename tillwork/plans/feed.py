"""CSV rows to a topic, and the topic to JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tillwork.streaming.messages import parse_messages, parse_or_quarantine, raw_messages
from tillwork.streaming.sinks import drain_to_json, start_json_sink


def customer_feed(
    messages: DataFrame, schema: StructType, parse: bool = True, quarantine: bool = False
) -> tuple[DataFrame, list[str]]:
    """Shape a stream of messages, and name the columns its files are foldered by.

    ``parse=False`` keeps the message text. ``quarantine`` sends malformed messages to a folder of
    their own in the same query, so the source is read once.
    """
    if not parse:
        return raw_messages(messages), []
    if quarantine:
        return parse_or_quarantine(messages, schema), ["malformed"]
    return parse_messages(messages, schema), []


def start_feed(
    messages: DataFrame,
    schema: StructType,
    path: str,
    checkpoint: str,
    parse: bool = True,
    quarantine: bool = False,
    trigger: dict | None = None,
):
    """Start the never-ending feed from messages to JSON files; returns the running query."""
    rows, folders = customer_feed(messages, schema, parse, quarantine)
    return start_json_sink(rows, path, checkpoint, trigger, folders)


def drain_feed(
    messages: DataFrame,
    schema: StructType,
    path: str,
    checkpoint: str,
    parse: bool = True,
    quarantine: bool = False,
) -> None:
    """Run the feed over the messages that have arrived, then stop."""
    rows, folders = customer_feed(messages, schema, parse, quarantine)
    drain_to_json(rows, path, checkpoint, folders)
