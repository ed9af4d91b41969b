"""Sales: cleansing, metrics, customer activity, report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators import metrics
from tillwork.operators.activity import customer_avg_orders_per_day as activity
from tillwork.operators.cleanse import date_audit, type_dates
from tillwork.operators.cleanse import distinct_values as distinct_of
from tillwork.plans.layers import build_layers, land_sales, sales_cleansed
from tillwork.plans.report import scalar_metrics, write_report
from tillwork.plans.report import text_lines as as_lines
from tillwork.session import scratch_path
from workload.customer_queries import AGE_SQL, AS_OF, NAME_SQL
from workload.entities import (
    CUSTOMERS_SQL,
    PRODUCTS_SQL,
    SALES_SQL,
    customers,
    products,
    sales,
    table,
    with_copies,
)
from workload.registry import ORACLES, iso, query

SALES_COLUMNS = (
    "strftime(OrderDate, '%Y-%m-%d') AS OrderDate, StockDate, OrderNumber, ProductKey, "
    "CustomerKey, TerritoryKey, OrderLineItem, OrderQuantity"
)

METRICS_SQL = f"""WITH {SALES_SQL},
per_order AS (SELECT OrderNumber, sum(OrderQuantity) AS units FROM sales GROUP BY 1),
per_day AS (SELECT OrderDate, count(DISTINCT OrderNumber) AS num_orders,
  sum(OrderQuantity) AS units FROM sales GROUP BY 1),
per_month AS (SELECT month(OrderDate) AS m, sum(OrderQuantity) AS units FROM sales GROUP BY 1),
metrics AS (
SELECT 'orders_placed' AS metric, CAST(count(*) AS DOUBLE) AS value FROM per_order
UNION ALL SELECT 'avg_orders_per_day', avg(num_orders) FROM per_day
UNION ALL SELECT 'avg_units_per_order', avg(units) FROM per_order
UNION ALL SELECT 'avg_units_per_day', avg(units) FROM per_day
UNION ALL SELECT 'avg_units_per_calendar_month', avg(units) FROM per_month
UNION ALL SELECT 'highest_product_price', max(p_retailprice) FROM part)"""

PRODUCT_ITEM = (
    "concat_ws('|', ProductKey, ProductSubcategoryKey, ProductName, ProductDescription, "
    "ProductColor, ProductSize)"
)


def typed(spark, sf_dir):
    return sales_cleansed(sales(spark, sf_dir))


def typed_iso(df):
    return df.select(iso("OrderDate"), *[c for c in df.columns if c not in ("OrderDate", "OrderYear")])


@query(f"WITH {SALES_SQL} SELECT {SALES_COLUMNS} FROM sales")
def sales_typed(spark, sf_dir):
    return typed_iso(typed(spark, sf_dir))


@query(f"WITH {SALES_SQL} SELECT {SALES_COLUMNS} FROM sales")
def sales_landed(spark, sf_dir):
    return typed_iso(land_sales(sales(spark, sf_dir), scratch_path(spark, "sales")))


@query(f"WITH {SALES_SQL} SELECT {SALES_COLUMNS} FROM sales")
def sales_dedup_copies(spark, sf_dir):
    doubled = with_copies(sales(spark, sf_dir), "OrderQuantity > 25")
    return typed_iso(sales_cleansed(doubled))


# Order dates as text in two known notations and an unknown one, some missing.
MIXED_DATES = """CASE WHEN o_orderpriority = '5-LOW' THEN NULL
    WHEN o_orderstatus = 'F' THEN date_format(o_orderdate, 'M/d/yyyy')
    WHEN o_orderstatus = 'O' THEN date_format(o_orderdate, 'yyyy-MM-dd')
    ELSE date_format(o_orderdate, 'dd MMM yyyy') END AS OrderDate"""


@query(
    """SELECT count(*) FILTER (WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P') AS parsed,
    count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS missing,
    count(*) FILTER (WHERE o_orderpriority <> '5-LOW' AND o_orderstatus = 'P') AS unparsed
    FROM orders"""
)
def sales_date_audit(spark, sf_dir):
    return date_audit(table(spark, sf_dir, "orders").selectExpr(MIXED_DATES), "OrderDate")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P'
    THEN strftime(o_orderdate, '%Y-%m-%d') END AS OrderDate FROM orders"""
)
def date_two_formats(spark, sf_dir):
    mixed = table(spark, sf_dir, "orders").selectExpr("o_orderkey", MIXED_DATES)
    return type_dates(mixed, "OrderDate").select("o_orderkey", iso("OrderDate"))


@query(
    f"""WITH {SALES_SQL} SELECT count(*) AS orders_placed
    FROM (SELECT DISTINCT OrderNumber FROM sales)"""
)
def orders_placed(spark, sf_dir):
    return metrics.orders_placed(typed(spark, sf_dir))


@query("SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def distinct_values(spark, sf_dir):
    return distinct_of(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")


@query(
    f"""WITH {SALES_SQL} SELECT strftime(OrderDate, '%Y-%m-%d') AS OrderDate,
    count(DISTINCT OrderNumber) AS num_orders FROM sales GROUP BY 1"""
)
def daily_orders(spark, sf_dir):
    return metrics.daily_orders(typed(spark, sf_dir)).select(iso("OrderDate"), "num_orders")


@query(
    f"""WITH {SALES_SQL} SELECT avg(n) AS avg_orders_per_day FROM
    (SELECT count(DISTINCT OrderNumber) AS n FROM sales GROUP BY OrderDate)"""
)
def avg_orders_per_day(spark, sf_dir):
    return metrics.avg_orders_per_day(typed(spark, sf_dir))


@query(
    f"""WITH {SALES_SQL} SELECT avg(u) AS avg_units_per_order FROM
    (SELECT sum(OrderQuantity) AS u FROM sales GROUP BY OrderNumber)"""
)
def avg_units_per_order(spark, sf_dir):
    return metrics.avg_units_per_order(typed(spark, sf_dir))


@query(
    f"""WITH {SALES_SQL} SELECT avg(u) AS avg_units_per_day FROM
    (SELECT sum(OrderQuantity) AS u FROM sales GROUP BY OrderDate)"""
)
def avg_units_per_day(spark, sf_dir):
    return metrics.avg_units_per_day(typed(spark, sf_dir))


@query(
    f"""WITH {SALES_SQL} SELECT avg(u) AS avg_units_per_calendar_month FROM
    (SELECT sum(OrderQuantity) AS u FROM sales GROUP BY month(OrderDate))"""
)
def avg_units_per_calendar_month(spark, sf_dir):
    return metrics.avg_units_per_calendar_month(typed(spark, sf_dir))


@query(
    f"""WITH {SALES_SQL} SELECT CAST(year(OrderDate) AS INTEGER) AS "Year",
    CAST(month(OrderDate) AS INTEGER) AS "Month", CAST(sum(OrderQuantity) AS BIGINT) AS units
    FROM sales GROUP BY 1, 2 ORDER BY 1 NULLS FIRST, 2 NULLS FIRST"""
)
def units_by_year_month(spark, sf_dir):
    return metrics.units_by_year_month(typed(spark, sf_dir))


@query(
    f"""WITH {SALES_SQL} SELECT strftime(OrderDate, '%Y-%m-%d') AS OrderDate, count(*) AS num_lines
    FROM sales GROUP BY 1 ORDER BY 1 NULLS FIRST"""
)
def lines_by_date(spark, sf_dir):
    return metrics.lines_by_date(typed(spark, sf_dir)).select(iso("OrderDate"), "num_lines")


@query(
    f"""{METRICS_SQL} SELECT max(CASE WHEN metric = 'orders_placed' THEN CAST(value AS BIGINT) END)
    AS orders_placed,
    max(CASE WHEN metric = 'avg_orders_per_day' THEN value END) AS avg_orders_per_day,
    max(CASE WHEN metric = 'avg_units_per_order' THEN value END) AS avg_units_per_order,
    max(CASE WHEN metric = 'avg_units_per_day' THEN value END) AS avg_units_per_day,
    max(CASE WHEN metric = 'avg_units_per_calendar_month' THEN value END)
    AS avg_units_per_calendar_month FROM metrics"""
)
def sales_summary(spark, sf_dir):
    return metrics.sales_summary(typed(spark, sf_dir))


SUMMARY_SQL = ORACLES["sales_summary"]


@query(SUMMARY_SQL)
def sales_summary_landed(spark, sf_dir):
    """The same metrics over the landed sales, as the report computes them."""
    landed = land_sales(sales(spark, sf_dir), scratch_path(spark, "summary-sales"))
    return metrics.sales_summary(landed)


@query(f"{METRICS_SQL} SELECT metric, value FROM metrics")
def sales_metrics_report(spark, sf_dir):
    return scalar_metrics(typed(spark, sf_dir), products(spark, sf_dir))


@query(
    f"""{METRICS_SQL} SELECT CASE metric WHEN 'orders_placed' THEN 'Orders placed'
    WHEN 'avg_orders_per_day' THEN 'Average orders placed in a day'
    WHEN 'avg_units_per_order' THEN 'Average units per order'
    WHEN 'avg_units_per_day' THEN 'Average units per day'
    WHEN 'avg_units_per_calendar_month' THEN 'Average units per calendar month'
    ELSE 'Highest product price' END || ': ' || printf('%.2f', value) AS line FROM metrics"""
)
def sales_report_lines(spark, sf_dir):
    return as_lines(scalar_metrics(typed(spark, sf_dir), products(spark, sf_dir)))


# Every part of the report in the same three columns: what a row is about, and its number.
REPORT_SQL = f"""{METRICS_SQL}, {PRODUCTS_SQL}, {CUSTOMERS_SQL}
SELECT 'metrics' AS part, metric AS item, value FROM metrics
UNION ALL SELECT 'units_by_year_month', concat_ws('|', year(OrderDate), month(OrderDate)),
  CAST(sum(OrderQuantity) AS DOUBLE) FROM sales GROUP BY year(OrderDate), month(OrderDate)
UNION ALL SELECT 'lines_by_date', strftime(OrderDate, '%Y-%m-%d'), CAST(count(*) AS DOUBLE)
  FROM sales GROUP BY OrderDate
UNION ALL SELECT * FROM (SELECT 'highest_priced_product', {PRODUCT_ITEM}, ProductPrice
  FROM products ORDER BY ProductPrice DESC, ProductKey LIMIT 1)
UNION ALL SELECT 'products_by_name', {PRODUCT_ITEM}, ProductPrice
  FROM (SELECT DISTINCT * FROM products)
UNION ALL SELECT 'customers_masked', concat_ws('|', CustomerKey, repeat('*', length({NAME_SQL})),
  repeat('*', length(EmailAddress)), repeat('*', length(Address)), repeat('*', length(PhoneNumber))),
  {AGE_SQL} FROM customers"""


@query(REPORT_SQL)
def sales_report_tables(spark, sf_dir):
    """The whole report as landed tables, with the sales landed once before; all rows of all parts."""
    root = scratch_path(spark, "report")
    landed = land_sales(sales(spark, sf_dir), f"{root}/sales")
    parts = write_report(
        landed, products(spark, sf_dir), customers(spark, sf_dir), f"{root}/parts", as_of=AS_OF
    )
    masked = ["masked_name", "masked_email", "masked_address", "masked_phone"]
    shown = {
        "metrics": ("metric", "value"),
        "units_by_year_month": (F.concat_ws("|", "Year", "Month"), "units"),
        "lines_by_date": (F.date_format("OrderDate", "yyyy-MM-dd"), "num_lines"),
        "highest_priced_product": (F.expr(PRODUCT_ITEM), "ProductPrice"),
        "products_by_name": (F.expr(PRODUCT_ITEM), "ProductPrice"),
        "customers_masked": (F.concat_ws("|", "CustomerKey", *masked), "Age"),
    }
    rows = [
        parts[name].select(
            F.lit(name).alias("part"),
            (F.col(item) if isinstance(item, str) else item).alias("item"),
            F.col(value).cast("double").alias("value"),
        )
        for name, (item, value) in shown.items()
    ]
    return reduce(DataFrame.unionAll, rows)


ACTIVITY_SQL = f"""WITH {SALES_SQL}, per_day AS (
  SELECT CustomerKey, OrderDate, count(DISTINCT OrderNumber) AS NumOrders
  FROM sales GROUP BY 1, 2)
SELECT CustomerKey, strftime(OrderDate, '%Y-%m-%d') AS OrderDate, NumOrders,
  avg(NumOrders) OVER (PARTITION BY CustomerKey) AS AvgOrdersPerDay FROM per_day"""


def activity_iso(df):
    return df.select("CustomerKey", iso("OrderDate"), "NumOrders", "AvgOrdersPerDay")


@query(ACTIVITY_SQL)
def customer_avg_orders_per_day(spark, sf_dir):
    return activity_iso(activity(typed(spark, sf_dir)))


@query(ACTIVITY_SQL)
def layers_customer_activity(spark, sf_dir):
    """The curated table of the layered job, read back."""
    layers = build_layers(
        customers(spark, sf_dir), sales(spark, sf_dir), scratch_path(spark, "layers")
    )
    return activity_iso(layers["customer_activity"])
