"""Stateful streams: each message once, and distinct orders per day, both within a bounded delay.

State is keyed and bounded by the watermark: it holds what is younger than the latest time seen minus
the delay. It lies in RocksDB on the executors' disks, not on their heaps, and its changes are saved
with the checkpoint, so a lost executor or a restart continues where the last batch ended.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def keep_state_on_disk(spark: SparkSession) -> SparkSession:
    """Make the session's streams keep their state in RocksDB. A stream must keep to the provider its
    checkpoint began with."""
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    return spark


def once_each(stream: DataFrame, time: str, delay: str, keys: Sequence[str] = ()) -> DataFrame:
    """A stream with each message once.

    A copy is dropped if its ``time`` lies within ``delay`` of the first, also in another batch or
    after a restart. ``keys`` identify a message; without them all its columns do, as one digest.
    A message whose time is older than the latest seen minus ``delay`` is late and dropped, for it can
    no longer be told from a copy; the query's progress counts it. A message without a time is never
    late, and only its copies in the same batch are sure to be dropped.
    """
    timed = stream.withWatermark(time, delay)
    if keys:
        return timed.dropDuplicatesWithinWatermark(list(keys))
    digest = F.sha2(F.to_json(F.struct(*stream.columns), {"ignoreNullFields": "false"}), 256)
    return timed.withColumn("_digest", digest).dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def daily_distinct(stream: DataFrame, time: str, key: str, delay: str, name: str = "num_orders") -> DataFrame:
    """Distinct keys per day of ``time``: ``Day`` and ``name``, once the day is closed.

    A day closes when the latest time seen is ``delay`` past its end; rows that come later are late.
    Keys are deduplicated per day first, spread over all tasks, so a busy day is no hot group: what
    reaches the day's count is summed in each task. NULL keys are not counted.
    """
    day = F.window(time, "1 day")
    first = (
        stream.where(F.col(key).isNotNull())
        .withWatermark(time, delay)
        .select(day.alias("_day"), F.col(key).alias("_key"))
        .dropDuplicates(["_day", "_key"])
    )
    return first.groupBy("_day").agg(F.count("*").alias(name)).select(
        F.to_date("_day.start").alias("Day"), name
    )


@dataclass(frozen=True)
class Drained:
    """What a run over all that has arrived did."""

    rows: int
    late: int


def drain_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> Drained:
    """Store what a stateful stream yields of all that has arrived, then stop; counts the rows read and
    those that came too late, which are not in the result."""
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    seen: dict[int, tuple[int, int]] = {}
    while not query.awaitTermination(1):
        seen |= _progress(query)
    seen |= _progress(query)
    return Drained(sum(rows for rows, _ in seen.values()), sum(late for _, late in seen.values()))


def _progress(query: StreamingQuery) -> dict[int, tuple[int, int]]:
    """Rows read and late rows of the latest batches; Spark keeps the last hundred."""
    return {
        batch["batchId"]: (
            batch["numInputRows"],
            sum(state["numRowsDroppedByWatermark"] for state in batch["stateOperators"]),
        )
        for batch in query.recentProgress
    }
