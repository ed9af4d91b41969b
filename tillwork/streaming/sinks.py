"""Streaming file sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillwork.sources.files import EXACT_TIMES


def start_json_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to JSON Lines files and return the running query.

    Each message is stored exactly once per checkpoint; a lost executor or a restart on the same
    checkpoint repeats nothing, while a deleted checkpoint replays the whole source. ``trigger`` is
    as for ``DataStreamWriter.trigger``, e.g. ``{"availableNow": True}``; by default micro-batches
    follow one another until the query is stopped.
    """
    writer = (
        stream.writeStream.outputMode("append")
        .format("json")
        .options(**EXACT_TIMES)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def drain_to_json(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> None:
    """Store all that has arrived so far, then stop."""
    start_json_sink(
        stream, path, checkpoint, {"availableNow": True}, partition_by
    ).awaitTermination()
