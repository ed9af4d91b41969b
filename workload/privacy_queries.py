"""Keyed pseudonyms, and distinct counts that roll up."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwork.functions.pseudonyms import pseudonymized, rekeyed, rekeying
from tillwork.operators.rollup import BOUND, daily_bitmaps, daily_sketches, rolled_up, rolled_up_estimate
from workload.entities import CUSTOMERS_SQL, SALES_SQL, customers
from workload.registry import query
from workload.sales_queries import typed

KEYS = {1: b"first key", 2: b"second key, longer than a block of the hash: " + b"x" * 40}


def keys(spark):
    return spark.createDataFrame([*KEYS.items()], "version int, key binary")


def hmac_sql(value: str, key: bytes) -> str:
    import hashlib

    block = (key if len(key) <= 64 else hashlib.sha256(key).digest()).ljust(64, b"\0")
    inner, outer = (bytes(b ^ pad for b in block).hex() for pad in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({value}))))"


@query(
    f"""WITH {CUSTOMERS_SQL} SELECT CustomerKey, {hmac_sql("EmailAddress", KEYS[2])} AS EmailAddress,
    {hmac_sql("PhoneNumber", KEYS[2])} AS PhoneNumber, 2 AS KeyVersion FROM customers"""
)
def customer_pseudonyms(spark, sf_dir):
    """E-mail and phone under the latest key."""
    rows = customers(spark, sf_dir).select("CustomerKey", "EmailAddress", "PhoneNumber")
    return pseudonymized(rows, keys(spark), "EmailAddress", "PhoneNumber")


@query(
    f"""WITH {CUSTOMERS_SQL} SELECT CustomerKey, CASE WHEN CustomerKey % 7 <> 0
    THEN {hmac_sql("EmailAddress", KEYS[2])} END AS EmailAddress, 2 AS KeyVersion FROM customers"""
)
def customer_rekeyed(spark, sf_dir):
    """A table of old pseudonyms moved to the new key; some customers' clear values are gone."""
    rows = customers(spark, sf_dir).select("CustomerKey", "EmailAddress")
    stored = pseudonymized(rows, keys(spark), "EmailAddress", version=1)
    mapping = rekeying(rows.where("CustomerKey % 7 <> 0"), keys(spark), "EmailAddress", 1, 2)
    return rekeyed(stored, mapping, "EmailAddress", 2)


MONTHS = {"Year": F.year, "Month": F.month}


def periods():
    return {name: of("OrderDate") for name, of in MONTHS.items()}


@query(
    f"""WITH {SALES_SQL} SELECT year(OrderDate)::INTEGER AS Year, month(OrderDate)::INTEGER AS Month,
    count(DISTINCT CustomerKey)::BIGINT AS num_customers FROM sales GROUP BY 1, 2"""
)
def customers_by_month_rolled_up(spark, sf_dir):
    """Distinct customers of a month from the bitmaps of its days."""
    return rolled_up(daily_bitmaps(typed(spark, sf_dir), "CustomerKey"), "num_customers", **periods())


@query(
    f"""WITH {SALES_SQL} SELECT year(OrderDate)::INTEGER AS Year, month(OrderDate)::INTEGER AS Month,
    count(DISTINCT OrderNumber)::BIGINT AS num_orders, 1 AS within_bound FROM sales GROUP BY 1, 2"""
)
def orders_by_month_estimated(spark, sf_dir):
    """Distinct orders of a month exactly, and whether the estimate from its days keeps its bound."""
    sales = typed(spark, sf_dir)
    estimated = rolled_up_estimate(daily_sketches(sales, "OrderNumber"), "estimate", **periods())
    exact = rolled_up(daily_bitmaps(sales, "OrderNumber"), "num_orders", **periods())
    off = F.abs(F.col("estimate") / F.col("num_orders") - 1)
    return exact.join(estimated, ["Year", "Month"]).select(
        "Year", "Month", "num_orders", (off <= BOUND).cast("int").alias("within_bound")
    )
