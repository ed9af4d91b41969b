"""Times alternative ways to compute the same result; prints one JSON line per measurement.

    python benchmarks/compare.py [sf_dir]

The sales are landed once before the clock starts wherever a measurement says "landed". Each time is
the best of three runs into the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tillwork.functions.privacy import stars  # noqa: E402
from tillwork.operators import metrics  # noqa: E402
from tillwork.operators.activity import customer_avg_orders_per_day  # noqa: E402
from tillwork.operators.enrich import with_full_name  # noqa: E402
from tillwork.operators.protect import MASKED_NAMES  # noqa: E402
from tillwork.plans.feed import drain_feed  # noqa: E402
from tillwork.plans.layers import customers_cleansed, land_sales, sales_cleansed  # noqa: E402
from tillwork.session import apply_runtime_conf, remove_scratch, scratch_path  # noqa: E402
from tillwork.sources.files import read_json, write_json  # noqa: E402
from tillwork.streaming.messages import to_messages  # noqa: E402
from workload.entities import customers, sales  # noqa: E402
from workload.feed_queries import event_stream, events, write_json_arrays  # noqa: E402

METRICS = (
    metrics.orders_placed,
    metrics.avg_orders_per_day,
    metrics.avg_units_per_order,
    metrics.avg_units_per_day,
    metrics.avg_units_per_calendar_month,
)


def best(work, runs: int = 3) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(min(times), 2)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def report(measurement: str, **values) -> None:
    print(json.dumps({"measurement": measurement, **values}), flush=True)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    raw = sales(spark, sf_dir)
    landed = land_sales(raw, scratch_path(spark, "compare-sales"))
    landed_hot = landed.withColumn(
        "CustomerKey",
        F.when(F.pmod(F.hash("OrderNumber"), F.lit(3)) > 0, F.col("CustomerKey")),
    )
    drain(customer_avg_orders_per_day(landed))

    for name, table in {"landed": landed, "landed, a third NULL": landed_hot}.items():
        report(
            f"customer activity, {name}",
            spread=best(lambda t=table: drain(customer_avg_orders_per_day(t))),
            all_in_one_exchange=best(
                lambda t=table: drain(customer_avg_orders_per_day(t.repartition("CustomerKey")))
            ),
        )

    report(
        "five scalar metrics",
        one_scan_each=best(lambda: [drain(m(sales_cleansed(raw))) for m in METRICS]),
        one_scan_each_landed=best(lambda: [drain(m(landed)) for m in METRICS]),
        single_pass=best(lambda: drain(metrics.sales_summary(sales_cleansed(raw)))),
        single_pass_landed=best(lambda: drain(metrics.sales_summary(landed))),
        landing=best(lambda: land_sales(raw, scratch_path(spark, "compare-sales"))),
    )

    # Twenty copies, so that the work outweighs starting a job.
    named = with_full_name(customers(spark, sf_dir))
    people = scratch_path(spark, "compare-customers")
    named.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20)))).write.parquet(people)
    many = spark.read.parquet(people)
    python_stars = F.udf(lambda text: None if text is None else "*" * len(text), "string")
    report(
        "masking four columns",
        rows=many.count(),
        native=best(lambda: drain(many.select([stars(c).alias(n) for c, n in MASKED_NAMES.items()]))),
        python_udf=best(
            lambda: drain(many.select([python_stars(c).alias(n) for c, n in MASKED_NAMES.items()]))
        ),
    )
    report(
        "customer cleanse",
        rows=many.count(),
        seconds=best(lambda: drain(customers_cleansed(many.drop("copy", "FullName")))),
    )

    lines, document = scratch_path(spark, "compare-json"), scratch_path(spark, "compare-document")
    parquet = scratch_path(spark, "compare-parquet")
    write_json(many, lines)
    write_json_arrays(many.coalesce(1), document)
    many.write.parquet(parquet)
    schema = many.schema
    report(
        "scan of all customer columns",
        rows=many.count(),
        one_multi_line_document=best(lambda: drain(read_json(spark, document, schema, multi_line=True))),
        json_lines=best(lambda: drain(read_json(spark, lines, schema, multi_line=False))),
        parquet=best(lambda: drain(spark.read.parquet(parquet))),
    )

    def feed() -> None:
        root = scratch_path(spark, "compare-feed")
        drain_feed(
            to_messages(event_stream(spark, sf_dir)),
            events(spark, sf_dir).schema,
            f"{root}/out",
            f"{root}/checkpoint",
        )

    count = events(spark, sf_dir).count()
    seconds = best(feed)
    report("feed to JSON files", rows=count, seconds=seconds, rows_per_second=round(count / seconds))
    remove_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
