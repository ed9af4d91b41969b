"""End-to-end jobs on small entities, physical plans, and hot keys."""

import datetime
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillwork import schemas
from tillwork.operators import metrics
from tillwork.operators.activity import customer_avg_orders_per_day
from tillwork.operators.cleanse import dedup, drop_nulls
from tillwork.operators.ordering import sorted_by, top_k, top_k_distinct
from tillwork.plans import enrichment
from tillwork.plans.layers import build_layers, customers_cleansed, customers_raw, sales_cleansed
from tillwork.plans.report import scalar_metrics, text_lines, write_report
from tillwork.sources.files import write_table

CUSTOMER = (1, "Mr", "Ann", "Lee", "1/1/2000", "M", "F", "a@x", "$90,000 ", 2, "BSc", "Cook", "Y")
CUSTOMERS = [
    (*CUSTOMER, "555-1234", "1 Road"),
    (*CUSTOMER, "555-1234", "1 Road"),
    (2, None, "Bo", "Lee", "bad", "S", "M", None, None, 0, "BSc", "Cook", "N", None, "2 Road"),
]
PRODUCTS = [
    (1, 1, "cap", "a cap", None, "Small", 4.0, 10.0),
    (3, 1, "vest", "a vest", "red", "XL", 1.0, 50.0),
    (2, 1, "bag", None, "red", None, None, 50.0),
    (2, 1, "bag", None, "red", None, None, 50.0),
]
SALES = [
    ("1/5/2015", "1/1/2015", "SO1", 1, 1, 1, 1, 2),
    ("1/5/2015", "1/1/2015", "SO1", 1, 1, 1, 1, 2),
    ("1/5/2015", "1/1/2015", "SO1", 2, 1, 1, 2, 3),
    ("2016-01-06", "1/1/2015", "SO2", 1, 1, 1, 1, 7),
    ("bad", "1/1/2015", "SO3", 1, None, 1, 1, 1),
]


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(CUSTOMERS, schemas.CUSTOMERS)


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(PRODUCTS, schemas.PRODUCTS)


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(SALES, schemas.SALES)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_customers_cleansed(customers):
    raw = customers_raw(customers).collect()
    assert [row.FullName for row in raw] == ["Mr Ann Lee"]
    (row,) = customers_cleansed(customers).collect()
    assert row.BirthDate == datetime.date(2000, 1, 1)
    assert {len(row[name]) for name in ("FullName", "EmailAddress", "PhoneNumber", "Address")} == {64}
    assert not {"FirstName", "LastName", "Prefix", "Gender"} & set(row.asDict())
    assert customers_cleansed(customers, salt="s").collect()[0].FullName != row.FullName


def test_sales_cleansed(sales):
    rows = sales_cleansed(sales).collect()
    assert len(rows) == 4
    assert Counter(row.OrderDate for row in rows) == {
        datetime.date(2015, 1, 5): 2,
        datetime.date(2016, 1, 6): 1,
        None: 1,
    }


def test_layers(customers, sales, tmp_path):
    layers = build_layers(customers, sales, str(tmp_path))
    assert {name: table.count() for name, table in layers.items()} == {
        "customers": 1,
        "sales": 4,
        "customer_activity": 3,
    }
    assert (tmp_path / "cleansed" / "sales" / "OrderYear=2015").is_dir()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        build_layers(customers, sales, str(tmp_path))
    assert build_layers(customers, sales, str(tmp_path), "overwrite")["sales"].count() == 4


def by_key(df, key):
    return {row[key]: row for row in df.collect()}


def test_customer_enrichment(customers):
    rows = by_key(enrichment.customers_enriched(customers, "2020-01-01"), "CustomerKey")
    assert rows[1].Age == 7305 / 365 and rows[1].IncomeCategory == "Medium"
    assert (rows[2].FullName, rows[2].Age, rows[2].IncomeCategory) == ("Bo Lee", None, "High")
    labelled = by_key(enrichment.customers_enriched(customers, null_label="None"), "CustomerKey")
    assert labelled[2].IncomeCategory == "None"
    curated = by_key(enrichment.customers_curated(customers), "CustomerKey")
    assert (curated[1].AnnualIncome, curated[1].FullName) == (90000, "Ann Lee")
    assert (curated[2].EmailAddress, curated[2].AnnualIncome) == ("", None)


def test_product_enrichment(products):
    filled = by_key(enrichment.products_curated(products), "ProductKey")
    assert (filled[1].ProductColor, filled[2].ProductSize) == ("", "")
    assert filled[1].DiscountedPrice == 9.0
    rows = by_key(enrichment.products_enriched(products), "ProductKey")
    assert (rows[1].ProductDescriptionLength, rows[1].ProductProfit) == (5, 6.0)
    assert (rows[2].ProductDescriptionLength, rows[2].ProductProfit) == (None, None)
    sizes = {key: row.ProductSizeCategory for key, row in rows.items()}
    assert sizes == {1: "S", 2: "Unknown", 3: "Unknown"}


def test_masked_customers(customers):
    masked = enrichment.customers_masked(customers)
    assert not {"Prefix", "FirstName", "LastName", "FullName", "EmailAddress"} & set(masked.columns)
    rows = by_key(masked, "CustomerKey")
    assert (rows[1].masked_name, rows[1].masked_phone) == ("*" * 10, "*" * 8)
    assert rows[2].masked_phone is None and rows[2].masked_email is None
    assert "PhoneNumber" not in rows[1].asDict()
    clear = enrichment.customers_masked(customers, drop_originals=False)
    assert {"PhoneNumber", "masked_phone"} <= set(clear.columns)


def test_report(sales, products, customers, tmp_path):
    cleansed = sales_cleansed(sales)
    values = {row.metric: row.value for row in scalar_metrics(cleansed, products).collect()}
    assert values == {
        "orders_placed": 3.0,
        "avg_orders_per_day": 1.0,
        "avg_units_per_order": 13 / 3,
        "avg_units_per_day": 13 / 3,
        "avg_units_per_calendar_month": 6.5,
        "highest_product_price": 50.0,
    }
    lines = {row.line for row in text_lines(scalar_metrics(cleansed, products)).collect()}
    assert {"Orders placed: 3.00", "Average units per order: 4.33"} <= lines
    parts = write_report(cleansed, products, customers, str(tmp_path), as_of="2020-01-01")
    assert parts["highest_priced_product"].collect()[0].ProductKey == 2
    names = [row.ProductName for row in parts["products_by_name"].coalesce(1).collect()]
    assert sorted(names) == ["bag", "cap", "vest"]
    assert parts["customers_masked"].count() == 3
    assert parts["lines_by_date"].count() == 3


def test_no_python_in_masking(customers):
    plan = plan_of(enrichment.customers_masked(customers, "2020-01-01"))
    assert "Python" not in plan and "Exchange" not in plan


def test_null_tests_reach_the_scan(spark, customers, tmp_path):
    path = str(tmp_path / "c")
    customers.write.parquet(path)
    plan = plan_of(drop_nulls(spark.read.parquet(path)))
    assert "IsNotNull(EmailAddress)" in plan and "IsNotNull(PhoneNumber)" in plan


def test_top_k_moves_k_rows_per_task(products):
    plan = plan_of(top_k(products, "ProductPrice", 2, ["ProductKey"]))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_bound_of_the_top_products_reaches_the_scan(spark, products, tmp_path):
    path = str(tmp_path / "p")
    products.write.parquet(path)
    top = top_k_distinct(spark.read.parquet(path), "ProductPrice", 2, ["ProductKey"])
    assert [row.ProductKey for row in top.collect()] == [2, 3]
    assert "GreaterThanOrEqual(ProductPrice" in plan_of(top)


def test_report_reads_raw_products_once(spark, sales, products, customers, tmp_path):
    """Only the table in name order reads the given products; the other parts read that table."""
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    watched = products.mapInPandas(counted, products.schema)
    write_report(sales_cleansed(sales), watched, customers, str(tmp_path / "r"), as_of="2020-01-01")
    assert reads.value == len(PRODUCTS)


def test_landing_computes_its_rows_once(spark, sales, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    watched = sales_cleansed(sales).mapInPandas(counted, sales_cleansed(sales).schema)
    back = write_table(watched, str(tmp_path / "s"), partition_by=["CustomerKey"], sort_by=["OrderDate"])
    assert back.count() == reads.value == 4


def test_children_that_are_ints_are_not_cast(customers):
    plan = plan_of(enrichment.customers_curated(customers))
    assert not re.search(r"cast\(TotalChildren", plan)


def test_metrics_read_only_their_columns(spark, sales, tmp_path):
    path = str(tmp_path / "s")
    sales_cleansed(sales).write.parquet(path)
    landed = spark.read.parquet(path)
    plan = plan_of(metrics.sales_summary(landed))
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<OrderDate:date,OrderNumber:string,OrderQuantity:int>" in plan
    activity = plan_of(customer_avg_orders_per_day(landed))
    assert "OrderQuantity" not in activity


@pytest.fixture
def uncoalesced(spark):
    """Adaptive execution left free to split partitions but not to merge them."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield spark
    spark.conf.unset(name)


def largest_share(df):
    counts = [row["count"] for row in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def test_hot_sort_value_is_split_by_its_tie_breaker(uncoalesced):
    df = uncoalesced.range(0, 20000, numPartitions=4).selectExpr(
        "if(id % 2 = 0, 'hot', concat('name', id)) AS name", "id"
    )
    assert largest_share(sorted_by(df, "name")) >= 0.5
    assert largest_share(sorted_by(df, "name", tie_breakers=["id"])) < 0.4


def test_many_copies_of_a_row_collapse_before_the_shuffle(uncoalesced):
    df = uncoalesced.range(0, 20000, numPartitions=4).selectExpr(
        "if(id % 3 = 0, -1, id) AS id", "'x' AS s"
    )
    plan = plan_of(dedup(df))
    exchange = plan.index("Exchange")
    assert "HashAggregate" in plan[:exchange] and "HashAggregate" in plan[exchange:]
    assert dedup(df).count() == df.select("id").distinct().count()


def test_hot_customer_is_counted_by_many_tasks(uncoalesced, tmp_path):
    """A customer with two thirds of all sales reaches the window as one row per date."""
    path = str(tmp_path / "s")
    uncoalesced.range(0, 30000, numPartitions=4).selectExpr(
        "if(id % 3 = 0, cast(id % 500 AS int), -1) AS CustomerKey",
        "date_add(DATE'2015-01-01', cast(id % 90 AS int)) AS OrderDate",
        "id AS OrderNumber",
    ).write.parquet(path)
    sales = uncoalesced.read.parquet(path)
    plan = plan_of(customer_avg_orders_per_day(sales))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
    assert [re.sub(r"#\d+L?", "", key) for key in keys] == [
        "CustomerKey",
        "CustomerKey, OrderDate",
        "CustomerKey, OrderDate, OrderNumber",
    ]
    hot = customer_avg_orders_per_day(sales).filter("CustomerKey = -1")
    assert hot.count() <= 90
    assert hot.agg(F.sum("NumOrders")).collect()[0][0] == 20000


def test_hot_join_key_is_split_though_a_grouping_follows(uncoalesced):
    """The session settings let adaptive execution split a hot order before a grouping on it."""
    spark = uncoalesced
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    force = "spark.sql.adaptive.forceOptimizeSkewedJoin"

    def split_plan():
        lines = spark.range(0, 40000, numPartitions=8).selectExpr(
            "if(id % 3 = 0, 7, id % 5000) AS k", "id AS line"
        )
        orders = spark.range(5000).selectExpr("id AS k", "id % 30 AS c").hint("merge")
        result = dedup(lines.join(orders, "k"))
        assert len(result.collect()) == 40000
        return "skew=true" in plan_of(result)

    try:
        assert split_plan()
        spark.conf.set(force, "false")
        assert not split_plan()
    finally:
        spark.conf.set(force, "true")
        for name in settings:
            spark.conf.unset(name)
