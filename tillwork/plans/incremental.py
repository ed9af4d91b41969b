"""Sales and customer activity, delivery by delivery.

A delivery reads and writes what it touches: the landed sales of its years between its first and last
date, and the activity of its months. Everything else stays as it lies, and each delivery becomes
visible in one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwork.plans.layers import sales_cleansed
from tillwork.session import remove_scratch, scratch_path
from tillwork.sources.versions import VersionedTables

#: The part of rows without a date.
UNDATED = "none"


def _staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _run(path: str) -> str:
    return path.rsplit("-", 1)[-1]


def _parts(rows: DataFrame, part: str) -> list[str]:
    """Years or months that occur: as many as the calendar has."""
    return sorted(row[0] for row in rows.select(part).distinct().collect())


def _part_of(date: str, notation: str):
    return F.coalesce(F.date_format(date, notation), F.lit(UNDATED))


# Sales


def deliver_sales(delivery: DataFrame, root: str) -> DataFrame:
    """Land what a delivery brings that is not landed yet, and return all landed sales.

    The delivery is cleansed as ``sales_cleansed`` does it. Its rows are compared with landed ones of
    its own years, and of these only with dates between its first and last, which file statistics
    skip by; NULL cells count as equal. New rows are added as folders of their own.
    """
    spark = delivery.sparkSession
    tables = VersionedTables(spark, root)
    version, listing = tables.latest()
    typed = sales_cleansed(delivery)
    schema = typed.schema
    new, path = _staged(typed.withColumn("_part", _part_of("OrderDate", "yyyy")), "delivery")
    paths, years = [path], _parts(new, "_part")
    landed = tables.read(listing, "sales", schema, years)
    if any(year in listing.get("sales", {}) for year in years):
        first, last = new.agg(F.min("OrderDate"), F.max("OrderDate")).first()
        near = F.col("OrderDate").between(F.lit(first), F.lit(last)) | F.col("OrderDate").isNull()
        same = [F.col(f"n.{c}").eqNullSafe(F.col(f"l.{c}")) for c in schema.names]
        new = new.alias("n").join(landed.where(near).alias("l"), same, "left_anti")
        # Sorting takes two passes over the rows; where nothing is landed yet they are staged already.
        new, other = _staged(new.select(*schema.names, "_part"), "new-sales")
        paths.append(other)
    ranges = ["_part", "OrderDate", "OrderNumber", *(c for c in schema.names if c not in ("OrderDate", "OrderNumber"))]
    in_order = new.repartitionByRange(*ranges).sortWithinPartitions("_part", "OrderDate", "OrderNumber")
    added = tables.write(in_order, "sales", _run(path), "_part")
    known = listing.get("sales", {})
    sales = known | {part: known.get(part, []) + folders for part, folders in added.items()}
    if added:
        listing = listing | {"sales": sales}
        tables.commit(version, listing)
    remove_scratch(spark, *paths)
    return tables.read(listing, "sales", schema)


def landed_sales(spark: SparkSession, root: str, schema: StructType, years=None) -> DataFrame:
    """All landed sales, or those of some years, from the latest version."""
    tables = VersionedTables(spark, root)
    parts = None if years is None else [str(year) for year in years]
    return tables.read(tables.latest()[1], "sales", schema, parts)


# Activity

_KEYS = ["CustomerKey", "OrderDate", "OrderNumber"]


def deliver_activity(added: DataFrame, root: str, removed: DataFrame | None = None) -> None:
    """Fold a delivery of typed sales lines, and lines it takes back, into the activity below ``root``.

    The state counts the lines of every order per customer and date, in folders by month, and the
    orders and days of every customer. Only the delivery's months are read and written anew; the
    customers' totals change by the difference those months make. A line delivered again counts again,
    so deliver what ``deliver_sales`` would add; lines taken back must have been delivered.
    """
    spark = added.sparkSession
    tables = VersionedTables(spark, root)
    version, listing = tables.latest()
    lines = added.select(*_KEYS, F.lit(1).cast("long").alias("lines"))
    if removed is not None:
        lines = lines.unionByName(removed.select(*_KEYS, F.lit(-1).cast("long").alias("lines")))
    delta = lines.groupBy(*_KEYS).agg(F.sum("lines").alias("lines"))
    delta, path = _staged(delta.withColumn("_part", _part_of("OrderDate", "yyyy-MM")), "activity-delta")
    months = _parts(delta, "_part")
    schema = delta.drop("_part").schema
    before = tables.read(listing, "orders", schema, months)
    after = (
        before.withColumn("_part", _part_of("OrderDate", "yyyy-MM"))
        .unionByName(delta)
        .groupBy(*_KEYS, "_part")
        .agg(F.sum("lines").alias("lines"))
        .where("lines > 0")
    )
    run = _run(path)
    # A month's rows come together, a large month's over several tasks: few files, and no hot one.
    gathered = after.select(*schema.names, "_part").hint("rebalance", F.col("_part"))
    written = tables.write(gathered, "orders", run, "_part")
    kept = {part: folders for part, folders in listing.get("orders", {}).items() if part not in months}
    changed = {"orders": kept | written}
    # Totals: as they were, less what those months held, plus what they hold now.
    now = tables.read(changed, "orders", schema, months)
    was = tables.read(listing, "totals", _totals(now, 1).schema)
    totals = was.unionByName(_totals(before, -1)).unionByName(_totals(now, 1))
    totals = totals.groupBy("CustomerKey").agg(F.sum("orders").alias("orders"), F.sum("days").alias("days"))
    changed["totals"] = tables.write(
        totals.where("days > 0").withColumn("_part", F.lit("all")), "totals", run, "_part"
    )
    tables.commit(version, listing | changed)
    remove_scratch(spark, path)


def _per_day(orders: DataFrame) -> DataFrame:
    """Orders per customer and date; missing order numbers are not counted, as in the full job."""
    return orders.groupBy("CustomerKey", "OrderDate").agg(F.count("OrderNumber").alias("NumOrders"))


def _totals(orders: DataFrame, sign: int) -> DataFrame:
    return (
        _per_day(orders)
        .groupBy("CustomerKey")
        .agg(
            (sign * F.sum("NumOrders")).cast("long").alias("orders"),
            (sign * F.count("*")).cast("long").alias("days"),
        )
    )


def customer_activity(spark: SparkSession, root: str, schema: StructType, months=None) -> DataFrame:
    """``customer_avg_orders_per_day`` of all deliveries; of some months only, with the mean over all.

    ``schema``: of the sales delivered.
    """
    tables = VersionedTables(spark, root)
    _, listing = tables.latest()
    keys = StructType([schema[name] for name in _KEYS]).add("lines", "long")
    orders = tables.read(listing, "orders", keys, months)
    totals = tables.read(listing, "totals", _totals(orders, 1).schema)
    days = _per_day(orders).alias("d")
    same = F.col("d.CustomerKey").eqNullSafe(F.col("t.CustomerKey"))
    return days.join(totals.alias("t"), same).select(
        "d.CustomerKey", "OrderDate", "NumOrders", (F.col("orders") / F.col("days")).alias("AvgOrdersPerDay")
    )

