"""Stateful streams and repeated producers over the test tables, with a restart between deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwork.plans.feed import drain_feed
from tillwork.session import scratch_path
from tillwork.sources.files import read_csv
from tillwork.streaming.compaction import compact, read_compacted
from tillwork.streaming.endpoints import file_topic_stream
from tillwork.streaming.ledger import publish_once, to_files
from tillwork.streaming.messages import parse_messages
from tillwork.streaming.state import daily_distinct, drain_to_parquet, keep_state_on_disk, once_each
from workload.entities import table
from workload.feed_queries import EVENTS_SQL, TEXT_CUSTOMERS_SQL, customer_csv, events, exact_time
from workload.registry import query


def publish(rows, topic):
    """Append messages, the times to the microsecond."""
    to_files(topic)(
        rows.select(F.to_json(F.struct("*"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("value")),
        scratch_path(rows.sparkSession, "delivery").rsplit("/", 1)[-1],
    )


def halves(rows, time):
    """The rows before and from the middle of their times."""
    low, high = rows.agg(F.min(time), F.max(time)).first()
    middle = low + (high - low) / 2
    return rows.where(F.col(time) < middle), rows.where(F.col(time) >= middle)


@query(EVENTS_SQL)
def stream_once_each(spark, sf_dir):
    """Events in two deliveries with a restart between them; the second repeats the first one's last
    day, and both hold copies of their own."""
    keep_state_on_disk(spark)
    root = scratch_path(spark, "once")
    rows = events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    first, second = halves(rows, "ts")
    tail = F.lit(first.agg(F.max("ts")).first()[0]) - F.expr("INTERVAL 1 DAY")
    second = second.unionByName(first.where(F.col("ts") > tail))
    for delivery in (first, second):
        publish(delivery.unionByName(delivery.where("event_id % 5 = 0")), f"{root}/topic")
        stream = parse_messages(file_topic_stream(spark, f"{root}/topic"), rows.schema)
        drain_to_parquet(once_each(stream, "ts", "2 days", ["event_id"]), f"{root}/out", f"{root}/state")
    return exact_time(spark.read.schema(rows.schema).parquet(f"{root}/out"))


@query(
    """WITH closed AS (SELECT max(o_orderdate) - INTERVAL 10 DAY AS until FROM orders)
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS Day, count(DISTINCT o_orderkey) AS num_orders
    FROM orders, closed GROUP BY o_orderdate, until HAVING date_trunc('day', o_orderdate) + INTERVAL 1 DAY <= until"""
)
def stream_daily_orders(spark, sf_dir):
    """Distinct orders of every closed day, from two deliveries of order lines; the second repeats
    orders and brings old ones of a closed year, which come too late."""
    keep_state_on_disk(spark)
    root = scratch_path(spark, "daily")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderNumber"), F.col("o_orderdate").cast("timestamp").alias("OrderTime")
    )
    first, second = halves(rows, "OrderTime")
    late = first.where(F.year("OrderTime") == F.year(F.lit(first.agg(F.min("OrderTime")).first()[0])))
    late = late.withColumn("OrderNumber", -F.col("OrderNumber") - 1)
    for delivery in (first, second.unionByName(late)):
        publish(delivery.unionByName(delivery.where("OrderNumber % 3 = 0")), f"{root}/topic")
        stream = parse_messages(file_topic_stream(spark, f"{root}/topic"), rows.schema)
        counts = daily_distinct(stream, "OrderTime", "OrderNumber", "10 days")
        drain_to_parquet(counts, f"{root}/out", f"{root}/state")
    stored = spark.read.schema("Day DATE, num_orders BIGINT").parquet(f"{root}/out")
    return stored.withColumn("Day", F.date_format("Day", "yyyy-MM-dd"))


@query(TEXT_CUSTOMERS_SQL)
def republish_once(spark, sf_dir):
    """Customers published by three runs of a producer: a part, all of them, and all again."""
    root = scratch_path(spark, "ledger")
    path, columns = customer_csv(spark, sf_dir)
    rows = read_csv(spark, path, columns)
    for delivery in (rows.where("CAST(CustomerKey AS BIGINT) % 3 = 0"), rows.unionByName(rows), rows):
        publish_once(delivery, f"{root}/ledger", to_files(f"{root}/topic"))
    messages = spark.read.option("recursiveFileLookup", "true").text(f"{root}/topic")
    return parse_messages(messages, rows.schema)


@query(EVENTS_SQL)
def stream_compacted(spark, sf_dir):
    """Events stored by a feed in two deliveries of many files, compacted after each and once in vain."""
    root = scratch_path(spark, "compacted")
    rows = events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    for delivery in halves(rows, "ts"):
        publish(delivery.repartition(8), f"{root}/topic")
        stream = file_topic_stream(spark, f"{root}/topic", max_files_per_trigger=4)
        drain_feed(stream, rows.schema, f"{root}/out", f"{root}/checkpoint")
        for _ in range(2):
            compact(spark, f"{root}/out", f"{root}/large", rows.schema)
    return exact_time(read_compacted(spark, f"{root}/out", f"{root}/large", rows.schema))
