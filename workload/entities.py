"""Retail entities derived from the test tables, in Spark and as SQL.

Keys stay 64-bit. Missing cells, decorated amounts and text dates are made from other columns, since
the tables hold none. ``*_SQL`` are the same entities for the SQL engine, as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwork.session import scale_shuffles


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path_of(sf_dir, name))


def path_of(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS CustomerKey",
        "CASE WHEN c_nationkey < 8 THEN 'MR.' WHEN c_nationkey < 16 THEN 'MS.' END AS Prefix",
        "split_part(c_name, '#', 1) AS FirstName",
        "nullif(split_part(c_name, '#', 2), '000000007') AS LastName",
        "date_format(date_add(DATE'1940-01-01', cast(c_custkey % 20000 AS INT)), 'M/d/yyyy')"
        " AS BirthDate",
        "CASE WHEN c_acctbal < 5000 THEN 'M' ELSE 'S' END AS MaritalStatus",
        "CASE WHEN c_nationkey < 12 THEN 'F' ELSE 'M' END AS Gender",
        "CASE WHEN c_mktsegment <> 'BUILDING'"
        " THEN concat(lower(replace(c_name, '#', '.')), '@example.com') END AS EmailAddress",
        "CASE c_custkey % 25 WHEN 1 THEN '$3,000,000,000' WHEN 2 THEN '-$3,000,000,000'"
        " WHEN 3 THEN '90d' WHEN 4 THEN '1e5' ELSE"
        " concat('$', format_number(cast(floor(c_acctbal) AS BIGINT) * 12, 0), ' ') END AS AnnualIncome",
        "c_nationkey % 6 AS TotalChildren",
        "CASE WHEN c_acctbal < 2500 THEN 'High School' ELSE 'Bachelors' END AS EducationLevel",
        "c_mktsegment AS Occupation",
        "CASE WHEN c_acctbal < 0 THEN 'N' ELSE 'Y' END AS HomeOwner",
        "concat('555-', lpad(cast(c_custkey AS STRING), 12, '0')) AS PhoneNumber",
        "concat(c_nationkey, ' ', c_mktsegment, ' Street') AS Address",
    )


CUSTOMERS_SQL = """customers AS (
  SELECT c_custkey AS CustomerKey,
    CASE WHEN c_nationkey < 8 THEN 'MR.' WHEN c_nationkey < 16 THEN 'MS.' END AS Prefix,
    split_part(c_name, '#', 1) AS FirstName,
    nullif(split_part(c_name, '#', 2), '000000007') AS LastName,
    strftime(DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%-m/%-d/%Y') AS BirthDate,
    CASE WHEN c_acctbal < 5000 THEN 'M' ELSE 'S' END AS MaritalStatus,
    CASE WHEN c_nationkey < 12 THEN 'F' ELSE 'M' END AS Gender,
    CASE WHEN c_mktsegment <> 'BUILDING'
      THEN lower(replace(c_name, '#', '.')) || '@example.com' END AS EmailAddress,
    CASE c_custkey % 25 WHEN 1 THEN '$3,000,000,000' WHEN 2 THEN '-$3,000,000,000'
      WHEN 3 THEN '90d' WHEN 4 THEN '1e5' ELSE
      '$' || format('{:,}', CAST(floor(c_acctbal) AS BIGINT) * 12) || ' ' END AS AnnualIncome,
    c_nationkey % 6 AS TotalChildren,
    CASE WHEN c_acctbal < 2500 THEN 'High School' ELSE 'Bachelors' END AS EducationLevel,
    c_mktsegment AS Occupation,
    CASE WHEN c_acctbal < 0 THEN 'N' ELSE 'Y' END AS HomeOwner,
    '555-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS PhoneNumber,
    c_nationkey || ' ' || c_mktsegment || ' Street' AS Address
  FROM customer)"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS ProductKey",
        "p_size AS ProductSubcategoryKey",
        "p_name AS ProductName",
        "concat_ws(' ', p_name, p_type, p_brand) AS ProductDescription",
        "nullif(p_brand, 'Brand#2') AS ProductColor",
        "CASE p_type WHEN 'SMALL' THEN 'Small' WHEN 'MEDIUM' THEN 'Medium'"
        " WHEN 'LARGE' THEN 'Large' WHEN 'PROMO' THEN NULL ELSE p_type END AS ProductSize",
        "cast(p_size AS DOUBLE) * 10 AS ProductCost",
        "p_retailprice AS ProductPrice",
    )


PRODUCTS_SQL = """products AS (
  SELECT p_partkey AS ProductKey, p_size AS ProductSubcategoryKey, p_name AS ProductName,
    p_name || ' ' || p_type || ' ' || p_brand AS ProductDescription,
    nullif(p_brand, 'Brand#2') AS ProductColor,
    CASE p_type WHEN 'SMALL' THEN 'Small' WHEN 'MEDIUM' THEN 'Medium'
      WHEN 'LARGE' THEN 'Large' WHEN 'PROMO' THEN NULL ELSE p_type END AS ProductSize,
    CAST(p_size AS DOUBLE) * 10 AS ProductCost, p_retailprice AS ProductPrice
  FROM part)"""


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order's date (as text) and customer.

    Both tables grow with the data, so neither is broadcast; deduplication and grouping by order
    reuse the shuffle on the order key, which has partitions in proportion to the files.
    """
    scale_shuffles(spark, path_of(sf_dir, "lineitem"), path_of(sf_dir, "orders"))
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").hint("merge")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(
        "date_format(o_orderdate, 'M/d/yyyy') AS OrderDate",
        "date_format(l_shipdate, 'M/d/yyyy') AS StockDate",
        "l_orderkey AS OrderNumber",
        "l_partkey AS ProductKey",
        "o_custkey AS CustomerKey",
        "l_suppkey AS TerritoryKey",
        "l_linenumber AS OrderLineItem",
        "cast(l_quantity AS INT) AS OrderQuantity",
    )


# Sales after deduplication and typing.
SALES_SQL = """sales AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS OrderDate,
    strftime(l_shipdate, '%-m/%-d/%Y') AS StockDate, l_orderkey AS OrderNumber,
    l_partkey AS ProductKey, o_custkey AS CustomerKey, l_suppkey AS TerritoryKey,
    l_linenumber AS OrderLineItem, CAST(l_quantity AS INTEGER) AS OrderQuantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def with_copies(df: DataFrame, condition: str) -> DataFrame:
    """A DataFrame followed by second copies of the rows that meet a condition."""
    return df.unionAll(df.filter(condition))
