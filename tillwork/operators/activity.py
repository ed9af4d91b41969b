"""Customer activity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def orders_per_customer_day(sales: DataFrame) -> DataFrame:
    """Distinct orders per customer and date; NULL customers and dates are groups of their own."""
    return sales.groupBy("CustomerKey", "OrderDate").agg(
        F.count_distinct("OrderNumber").alias("NumOrders")
    )


def customer_avg_orders_per_day(sales: DataFrame) -> DataFrame:
    """Orders per customer and active date, beside that customer's mean over active dates.

    Sales are spread by (customer, date, order) and copies collapse before each shuffle, so a customer
    holding a third of all sales is counted by many tasks. Only one row per customer and date reaches
    the window, which the calendar bounds.
    """
    per_customer = Window.partitionBy("CustomerKey")
    return orders_per_customer_day(sales).withColumn(
        "AvgOrdersPerDay", F.avg("NumOrders").over(per_customer)
    )
