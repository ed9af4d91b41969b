"""Priced revenue and its foreign-key join."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwork.operators import revenue

SALES = "OrderDate date, OrderNumber string, ProductKey int, OrderQuantity int"
PRODUCTS = "ProductKey int, ProductName string, ProductPrice double"


@pytest.fixture(scope="module")
def products(spark):
    rows = [(1, "a", 0.1), (1, "a2", 0.1), (2, "b", 3.0), (2, "b", 4.0), (3, "c", None), (None, "n", 9.0)]
    return spark.createDataFrame(rows, PRODUCTS)


@pytest.fixture(scope="module")
def sales(spark):
    rows = [("o1", 1, 3), ("o1", 2, 1), ("o2", 3, 5), ("o3", 4, 7), ("o4", None, 2), ("o5", 1, None)]
    return spark.createDataFrame(rows, "OrderNumber string, ProductKey int, OrderQuantity int").withColumn(
        "OrderDate", F.when(F.col("OrderNumber") < "o4", F.to_date(F.lit("2020-01-31")))
    )


SHUFFLED = {"broadcast_bytes": 0, "hot_share": 0.2, "splits": 4}


@pytest.mark.parametrize("how", [{}, SHUFFLED])
def test_every_sale_has_a_status(sales, products, how):
    rows = revenue.priced_sales(sales, products, **how).collect()
    got = sorted((r.OrderNumber, r.ProductKey or 0, r.Revenue, r.PriceStatus) for r in rows)
    assert got == [
        ("o1", 1, Decimal("0.3000"), "priced"),
        ("o1", 2, None, "several prices"),
        ("o2", 3, None, "no price"),
        ("o3", 4, None, "unknown product"),
        ("o4", 0, None, "unknown product"),
        ("o5", 1, None, "priced"),
    ]


@pytest.mark.parametrize("how", [{}, SHUFFLED])
def test_groups_and_means(sales, products, how):
    rows = revenue.revenue_by_year_month(sales, products, **how).collect()
    assert sorted(map(tuple, rows), key=str) == [
        (2020, 1, Decimal("0.3000"), 3, 13),
        (None, None, None, None, 2),
    ]
    mean = revenue.mean_revenue(sales, products, "OrderNumber", "mean", **how)
    assert mean.collect()[0].mean == 0.3
    left_out = {
        (r.ProductKey, r.PriceStatus, r.lines, r.units)
        for r in revenue.unpriced_products(sales, products, **how).collect()
    }
    assert left_out == {
        (2, "several prices", 1, 1),
        (3, "no price", 1, 5),
        (4, "unknown product", 1, 7),
        (None, "unknown product", 1, 2),
    }


@pytest.mark.parametrize("how", [{}, SHUFFLED])
def test_empty_tables(sales, products, how):
    assert revenue.priced_sales(sales.limit(0), products, **how).count() == 0
    statuses = revenue.priced_sales(sales, products.limit(0), **how).select("PriceStatus").distinct()
    assert [r[0] for r in statuses.collect()] == ["unknown product"]


def test_hot_product_is_spread(spark):
    facts = spark.range(6000).selectExpr(
        "id", "IF(id < 4000, 7, IF(id < 5000, NULL, id)) AS ProductKey"
    )
    dimension = spark.range(6000).selectExpr("id AS ProductKey", "id * 2 AS twice")
    assert revenue.hot_keys(facts, "ProductKey", 0.5) == [7]
    assert revenue.hot_keys(facts.limit(0), "ProductKey", 0.5) == []
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = revenue.lookup(facts, dimension, "ProductKey", broadcast_bytes=0, hot_share=0.5, splits=16)
        by_task = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in by_task) < 2600 and len(by_task) == 4
        right = joined.agg(
            F.count("*"),
            F.sum((F.col("twice") == 2 * F.col("ProductKey")).cast("int")),
            F.sum((~F.col("_known")).cast("int")),
        ).first()
        assert tuple(right) == (6000, 5000, 1000)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_broadcast_is_measured(spark):
    facts = spark.range(10).withColumnRenamed("id", "k")
    dimension = spark.range(1000).selectExpr("id AS k", "repeat('x', 100) AS text")
    assert revenue.value_bytes(dimension) == 108_000
    for limit, kind in ((120_000, True), (100_000, False)):
        plan = revenue.lookup(facts, dimension, "k", broadcast_bytes=limit)._jdf.queryExecution().analyzed()
        assert ("strategy=broadcast" in plan.toString()) == kind


def test_hot_keys_take_one_pass(spark):
    read = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    facts = spark.range(0, 1000, 1, 4).selectExpr("IF(id < 300, NULL, IF(id < 800, id % 2, id)) AS k")
    assert sorted(revenue.hot_keys(facts.mapInArrow(passed, "k long"), "k", 0.2)) == [0, 1]
    assert read.value == 1000
    assert revenue.hot_keys(facts, "k", 0.25) == []
