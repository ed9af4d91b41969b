"""Order and unit metrics over sales with a typed ``OrderDate`` and no duplicate rows.

"Units" are summed ``OrderQuantity``; no price is involved. A mean "per day" divides by the days
that have a sale, not by calendar days, and a calendar month pools that month of all years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators.cleanse import distinct_values
from tillwork.operators.ordering import sorted_by


def orders_placed(sales: DataFrame) -> DataFrame:
    """One row: number of distinct order numbers; a missing number counts as one more order."""
    return distinct_values(sales, "OrderNumber").agg(F.count("*").alias("orders_placed"))


def daily_orders(sales: DataFrame) -> DataFrame:
    """Distinct orders per date; missing order numbers are not counted, a NULL date is a group."""
    return sales.groupBy("OrderDate").agg(F.count_distinct("OrderNumber").alias("num_orders"))


def avg_orders_per_day(sales: DataFrame) -> DataFrame:
    """One row: mean of the distinct orders per date."""
    return daily_orders(sales).agg(F.avg("num_orders").alias("avg_orders_per_day"))


def _mean_units(sales: DataFrame, group: str, name: str) -> DataFrame:
    """One row: units summed per group, then averaged; NULL is a group, NULL sums are skipped."""
    units = sales.groupBy(group).agg(F.sum("OrderQuantity").alias("units"))
    return units.agg(F.avg("units").alias(name))


def avg_units_per_order(sales: DataFrame) -> DataFrame:
    """One row: mean units of an order."""
    return _mean_units(sales, "OrderNumber", "avg_units_per_order")


def avg_units_per_day(sales: DataFrame) -> DataFrame:
    """One row: mean units of a date."""
    return _mean_units(sales, "OrderDate", "avg_units_per_day")


def avg_units_per_calendar_month(sales: DataFrame) -> DataFrame:
    """One row: mean units of a month number, all years of a month taken together."""
    by_month = sales.withColumn("Month", F.month("OrderDate"))
    return _mean_units(by_month, "Month", "avg_units_per_calendar_month")


def units_by_year_month(sales: DataFrame) -> DataFrame:
    """Units per year and month in time order; sales without a date form the first row."""
    dated = sales.withColumns({"Year": F.year("OrderDate"), "Month": F.month("OrderDate")})
    units = dated.groupBy("Year", "Month").agg(F.sum("OrderQuantity").alias("units"))
    return sorted_by(units, "Year", "Month")


def lines_by_date(sales: DataFrame) -> DataFrame:
    """Order lines per date in time order; sales without a date form the first row."""
    lines = sales.groupBy("OrderDate").agg(F.count("*").alias("num_lines"))
    return sorted_by(lines, "OrderDate")


def sales_summary(sales: DataFrame) -> DataFrame:
    """One row with the five scalar metrics above, from one scan of the sales.

    Sales are first reduced to (date, order) totals. Grouping sets then regroup those totals by
    order, by date and by month in one further shuffle; dates and months collapse before it.
    """
    totals = (
        sales.groupBy("OrderDate", "OrderNumber")
        .agg(F.sum("OrderQuantity").alias("units"))
        .withColumn("Month", F.month("OrderDate"))
    )
    grains = totals.groupingSets(
        [["OrderNumber"], ["OrderDate"], ["Month"]], "OrderNumber", "OrderDate", "Month"
    ).agg(
        (F.grouping("OrderNumber") == 0).alias("is_order"),
        (F.grouping("OrderDate") == 0).alias("is_day"),
        (F.grouping("Month") == 0).alias("is_month"),
        F.sum("units").alias("units"),
        F.count("OrderNumber").alias("num_orders"),
    )
    return grains.agg(
        F.count_if("is_order").alias("orders_placed"),
        F.avg(F.when(F.col("is_day"), F.col("num_orders"))).alias("avg_orders_per_day"),
        F.avg(F.when(F.col("is_order"), F.col("units"))).alias("avg_units_per_order"),
        F.avg(F.when(F.col("is_day"), F.col("units"))).alias("avg_units_per_day"),
        F.avg(F.when(F.col("is_month"), F.col("units"))).alias("avg_units_per_calendar_month"),
    )
