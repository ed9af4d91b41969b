"""Priced revenue over sales and a product table with gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwork.operators import revenue
from workload.entities import PRODUCTS_SQL, SALES_SQL, products
from workload.registry import query
from workload.sales_queries import typed

# Some products are missing, some have no price, some have two.
CATALOG_SQL = f"""{PRODUCTS_SQL}, {SALES_SQL},
catalog AS (
  SELECT ProductKey, CASE WHEN ProductKey % 13 <> 0 THEN ProductPrice END AS ProductPrice
  FROM products WHERE ProductKey % 10 <> 3
  UNION ALL SELECT ProductKey, ProductPrice + 1 FROM products WHERE ProductKey % 17 = 0 AND ProductKey % 10 <> 3),
prices AS (
  SELECT ProductKey, min(CAST(ProductPrice AS DECIMAL(18,4))) AS low, max(CAST(ProductPrice AS DECIMAL(18,4))) AS high
  FROM catalog GROUP BY 1),
priced AS (
  SELECT s.*, CASE WHEN p.ProductKey IS NULL THEN 'unknown product' WHEN low <> high THEN 'several prices'
    WHEN low IS NULL THEN 'no price' ELSE 'priced' END AS PriceStatus,
    CASE WHEN low = high THEN low * OrderQuantity END AS Revenue
  FROM sales s LEFT JOIN prices p ON p.ProductKey = s.ProductKey)"""
SUMS_SQL = """CAST(sum(Revenue) AS DOUBLE) AS revenue,
  CAST(sum(OrderQuantity) FILTER (PriceStatus = 'priced') AS BIGINT) AS units,
  CAST(sum(OrderQuantity) FILTER (PriceStatus <> 'priced') AS BIGINT) AS unpriced_units"""


def catalog(spark, sf_dir):
    rows = products(spark, sf_dir).where("ProductKey % 10 <> 3")
    price = F.expr("CASE WHEN ProductKey % 13 <> 0 THEN ProductPrice END")
    second = rows.where("ProductKey % 17 = 0").withColumn("ProductPrice", F.col("ProductPrice") + 1)
    return rows.withColumn("ProductPrice", price).unionByName(second)


def as_double(df):
    return df.withColumn("revenue", F.col("revenue").cast("double"))


@query(
    f"""WITH {CATALOG_SQL} SELECT year(OrderDate)::INTEGER AS Year, month(OrderDate)::INTEGER AS Month, {SUMS_SQL}
    FROM priced GROUP BY 1, 2"""
)
def revenue_by_year_month(spark, sf_dir):
    return as_double(revenue.revenue_by_year_month(typed(spark, sf_dir), catalog(spark, sf_dir)))


@query(
    f"""WITH {CATALOG_SQL} SELECT year(OrderDate)::INTEGER AS Year, month(OrderDate)::INTEGER AS Month, {SUMS_SQL}
    FROM priced GROUP BY 1, 2"""
)
def revenue_by_year_month_shuffled(spark, sf_dir):
    """The same where the product table is too large to broadcast and some keys are hot."""
    rows = revenue.revenue_by_year_month(
        typed(spark, sf_dir), catalog(spark, sf_dir), broadcast_bytes=0, hot_share=0.001
    )
    return as_double(rows)


@query(
    f"""WITH {CATALOG_SQL}, per_order AS (SELECT OrderNumber, sum(Revenue) AS r FROM priced GROUP BY 1)
    SELECT CAST(sum(r) AS DOUBLE) / count(r) AS avg_revenue_per_order FROM per_order"""
)
def avg_revenue_per_order(spark, sf_dir):
    sales = typed(spark, sf_dir)
    return revenue.mean_revenue(sales, catalog(spark, sf_dir), "OrderNumber", "avg_revenue_per_order")


@query(
    f"""WITH {CATALOG_SQL}, per_day AS (SELECT OrderDate, sum(Revenue) AS r FROM priced GROUP BY 1)
    SELECT CAST(sum(r) AS DOUBLE) / count(r) AS avg_revenue_per_day FROM per_day"""
)
def avg_revenue_per_day(spark, sf_dir):
    return revenue.mean_revenue(typed(spark, sf_dir), catalog(spark, sf_dir), "OrderDate", "avg_revenue_per_day")


@query(
    f"""WITH {CATALOG_SQL} SELECT ProductKey, PriceStatus, count(*) AS lines,
    CAST(sum(OrderQuantity) AS BIGINT) AS units FROM priced WHERE PriceStatus <> 'priced' GROUP BY 1, 2"""
)
def unpriced_products(spark, sf_dir):
    return revenue.unpriced_products(typed(spark, sf_dir), catalog(spark, sf_dir))


@query(
    f"""WITH {CATALOG_SQL} SELECT OrderNumber, OrderLineItem, ProductKey, PriceStatus,
    CAST(Revenue AS DOUBLE) AS revenue FROM priced"""
)
def sales_priced(spark, sf_dir):
    """Every sale with its revenue, hot products spread over tasks."""
    priced = revenue.priced_sales(
        typed(spark, sf_dir), catalog(spark, sf_dir), broadcast_bytes=0, hot_share=0.001
    )
    return priced.select(
        "OrderNumber", "OrderLineItem", "ProductKey", "PriceStatus", F.col("Revenue").cast("double").alias("revenue")
    )
