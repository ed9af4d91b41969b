"""Files and messages: each query writes its input from the test tables and reads it back."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from tillwork import schemas
from tillwork.plans.feed import drain_feed
from tillwork.schemas import all_strings
from tillwork.session import scratch_path
from tillwork.sources.documents import land_documents
from tillwork.sources.files import read_csv, read_json, write_json
from tillwork.streaming.endpoints import file_topic_stream, publish_to_files
from tillwork.streaming.messages import parse_messages, raw_messages, to_messages
from workload.entities import CUSTOMERS_SQL, PRODUCTS_SQL, customers, products, table
from workload.registry import query

PRODUCTS_DDL = (
    "ProductKey BIGINT, ProductSubcategoryKey INT, ProductName STRING, ProductDescription STRING, "
    "ProductColor STRING, ProductSize STRING, ProductCost DOUBLE, ProductPrice DOUBLE"
)
TEXT_CUSTOMERS_SQL = (
    f"WITH {CUSTOMERS_SQL} SELECT * REPLACE (CAST(CustomerKey AS VARCHAR) AS CustomerKey, "
    "CAST(TotalChildren AS VARCHAR) AS TotalChildren) FROM customers"
)
EVENTS_SQL = "SELECT * REPLACE (strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts) FROM events"


def customer_csv(spark, sf_dir):
    """Customers as CSV files with a header; returns the folder and the column names."""
    path = scratch_path(spark, "customers-csv")
    rows = customers(spark, sf_dir)
    rows.write.option("header", "true").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return path, rows.columns


def events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def exact_time(rows):
    """The time as text to the microsecond, which compares everywhere."""
    return rows.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def event_stream(spark, sf_dir):
    """The events table as a stream, whether it is one file or a folder of files."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")


def write_json_arrays(rows, path):
    """Each partition as one file holding one JSON array, with a batch at a time in memory."""

    # Defined in here so that it travels to the executors by value.
    def bracket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lead = "["
        for batch in batches:
            if len(batch):
                lines = "," + batch["value"]
                lines.iloc[0] = lead + batch["value"].iloc[0]
                lead = ","
                yield lines.to_frame()
        yield pd.DataFrame({"value": ["]" if lead == "," else "[]"]})

    to_messages(rows).mapInPandas(bracket, "value STRING").write.text(path)


@query(TEXT_CUSTOMERS_SQL)
def csv_scan(spark, sf_dir):
    path, columns = customer_csv(spark, sf_dir)
    return read_csv(spark, path, columns)


@query(TEXT_CUSTOMERS_SQL)
def csv_scan_header_names(spark, sf_dir):
    return read_csv(spark, customer_csv(spark, sf_dir)[0])


@query(f"WITH {PRODUCTS_SQL} SELECT * FROM products")
def json_write(spark, sf_dir):
    path = scratch_path(spark, "products-json")
    write_json(products(spark, sf_dir), path)
    return read_json(spark, path, PRODUCTS_DDL, multi_line=False)


@query(f"WITH {PRODUCTS_SQL} SELECT * FROM products")
def json_scan_schema(spark, sf_dir):
    path = scratch_path(spark, "products-arrays")
    write_json_arrays(products(spark, sf_dir), path)
    return read_json(spark, path, PRODUCTS_DDL, multi_line=True)


@query(
    f"""WITH {PRODUCTS_SQL} SELECT * REPLACE (CAST(ProductKey AS INTEGER) AS ProductKey,
    CAST(ProductSubcategoryKey AS INTEGER) AS ProductSubcategoryKey) FROM products"""
)
def json_scan_declared(spark, sf_dir):
    """The declared schema of products over JSON Lines."""
    path = scratch_path(spark, "products-lines")
    write_json(products(spark, sf_dir), path)
    return read_json(spark, path, schemas.PRODUCTS, multi_line=False)


@query(f"WITH {PRODUCTS_SQL} SELECT * FROM products")
def json_document_landed(spark, sf_dir):
    """Documents landed as JSON Lines from byte ranges."""
    path, out = scratch_path(spark, "products-arrays"), scratch_path(spark, "products-lines")
    write_json_arrays(products(spark, sf_dir), path)
    land_documents(spark, path, out)
    return read_json(spark, out, PRODUCTS_DDL, multi_line=False)


@query(
    f"""WITH {PRODUCTS_SQL} SELECT * REPLACE
    (CAST(ProductSubcategoryKey AS BIGINT) AS ProductSubcategoryKey) FROM products"""
)
def json_scan_inferred(spark, sf_dir):
    path = scratch_path(spark, "products-arrays")
    write_json_arrays(products(spark, sf_dir), path)
    return read_json(spark, path, multi_line=True)


@query(
    f"""WITH {PRODUCTS_SQL}
    SELECT ProductKey, ProductName, CAST(1 AS INTEGER) AS size_is_null FROM products"""
)
def json_scan_misfit(spark, sf_dir):
    """Sizes are text and so do not fit the integer declared here: NULL cells, no lost rows."""
    path = scratch_path(spark, "products-json")
    write_json(products(spark, sf_dir), path)
    fitted = read_json(
        spark, path, "ProductKey BIGINT, ProductName STRING, ProductSize INT", multi_line=False
    )
    return fitted.select(
        "ProductKey", "ProductName", F.col("ProductSize").isNull().cast("int").alias("size_is_null")
    )


@query(EVENTS_SQL)
def json_roundtrip(spark, sf_dir):
    rows = events(spark, sf_dir)
    return exact_time(parse_messages(to_messages(rows), rows.schema))


@query(
    """SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k FROM events"""
)
def event_props_parsed(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k INT").alias("data")
    )
    return rows.select("event_id", "data.*")


@query(EVENTS_SQL)
def stream_json_sink(spark, sf_dir):
    """Events as messages, parsed by the feed and stored as JSON files."""
    root = scratch_path(spark, "feed")
    schema = events(spark, sf_dir).schema
    drain_feed(
        to_messages(event_stream(spark, sf_dir)), schema, f"{root}/out", f"{root}/checkpoint"
    )
    return exact_time(read_json(spark, f"{root}/out", schema, multi_line=False))


@query(EVENTS_SQL)
def stream_rerun_same_checkpoint(spark, sf_dir):
    """The same feed run twice on one checkpoint stores every event once."""
    root = scratch_path(spark, "feed")
    schema = events(spark, sf_dir).schema
    for _ in range(2):
        drain_feed(
            to_messages(event_stream(spark, sf_dir)), schema, f"{root}/out", f"{root}/checkpoint"
        )
    return exact_time(read_json(spark, f"{root}/out", schema, multi_line=False))


@query(EVENTS_SQL)
def stream_raw_sink(spark, sf_dir):
    """The feed without parsing; the stored texts are parsed on reading."""
    root = scratch_path(spark, "feed")
    schema = events(spark, sf_dir).schema
    drain_feed(
        to_messages(event_stream(spark, sf_dir)),
        schema,
        f"{root}/out",
        f"{root}/checkpoint",
        parse=False,
    )
    stored = read_json(spark, f"{root}/out", "value STRING", multi_line=False)
    return exact_time(parse_messages(raw_messages(stored), schema))


@query(
    """SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
    CASE WHEN event_type <> 'error' THEN regexp_extract(props, '"k": ([0-9]+)', 1) END AS k,
    CASE WHEN event_type = 'error'
      THEN '{"event_id": ' || event_id || ', ' || substr(props, 2, length(props) - 2) END AS malformed_text,
    CAST(event_type = 'error' AS INTEGER) AS malformed FROM events"""
)
def stream_quarantine(spark, sf_dir):
    """Messages of error events are cut short and so must land in quarantine."""
    root = scratch_path(spark, "feed")
    stream = (
        spark.readStream.schema(table(spark, sf_dir, "events").schema)
        .parquet(f"{sf_dir}/event[s].parquet")
        .selectExpr(
            """concat('{"event_id": ', event_id, ', ', CASE WHEN event_type = 'error'
              THEN substr(props, 2, length(props) - 2) ELSE substr(props, 2) END) AS value"""
        )
    )
    schema = spark.createDataFrame([], "event_id BIGINT, k INT").schema
    drain_feed(stream, schema, f"{root}/out", f"{root}/checkpoint", quarantine=True)
    stored = read_json(
        spark,
        f"{root}/out",
        "event_id BIGINT, k INT, malformed_text STRING, malformed BOOLEAN",
        multi_line=False,
    )
    identified = F.when(~F.col("malformed"), F.col("event_id")).alias("event_id")
    intact = F.when(~F.col("malformed"), F.col("k").cast("string")).alias("k")
    return stored.select(identified, intact, "malformed_text", F.col("malformed").cast("int"))


@query(TEXT_CUSTOMERS_SQL)
def csv_to_topic_to_json(spark, sf_dir):
    """CSV rows published as messages, followed as a stream, parsed and stored as JSON files."""
    root = scratch_path(spark, "feed")
    path, columns = customer_csv(spark, sf_dir)
    publish_to_files(read_csv(spark, path, columns), f"{root}/topic")
    schema = all_strings(columns)
    drain_feed(
        file_topic_stream(spark, f"{root}/topic"), schema, f"{root}/out", f"{root}/checkpoint"
    )
    return read_json(spark, f"{root}/out", schema, multi_line=False)
