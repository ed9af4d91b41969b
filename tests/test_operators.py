"""Operators on small fixtures, against hand-written rows or a plain Python count."""

import datetime
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillwork.operators import metrics
from tillwork.operators.activity import customer_avg_orders_per_day
from tillwork.operators.cleanse import (
    date_audit,
    dedup,
    distinct_values,
    drop_nulls,
    fill_nulls,
    type_dates,
    type_ints,
)
from tillwork.operators.ordering import sorted_by, top_k, top_k_distinct
from tillwork.operators.protect import hash_columns, mask_columns

SALES_DDL = "OrderDate date, OrderNumber string, CustomerKey int, OrderQuantity int"


def as_sets(df):
    return Counter(tuple(row) for row in df.collect())


def day(number):
    return datetime.date(2015, 1, 1) + datetime.timedelta(days=number)


@pytest.fixture(scope="module")
def sales_rows():
    """Two years of sales; one customer, one order and NULL keys hold a third of the rows each."""
    rng = random.Random(7)
    rows = []
    for number in range(3000):
        hot = number % 3 == 0
        rows.append(
            (
                rng.choice([None, day(40)]) if hot else day(rng.randrange(730)),
                rng.choice([None, "SO-hot"]) if hot else f"SO{rng.randrange(900)}",
                rng.choice([None, 1]) if hot else rng.randrange(40),
                rng.choice([None, 1, 2, 9]),
            )
        )
    return rows


@pytest.fixture(scope="module")
def sales(spark, sales_rows):
    return spark.createDataFrame(sales_rows, SALES_DDL)


def mean(numbers):
    numbers = [number for number in numbers if number is not None]
    return sum(numbers) / len(numbers)


def summed(rows, key):
    groups = defaultdict(list)
    for row in rows:
        groups[key(row)].append(row[3])
    return {
        group: sum(q for q in quantities if q is not None)
        if any(q is not None for q in quantities)
        else None
        for group, quantities in groups.items()
    }


def test_drop_nulls(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (2, None, 1.0), (3, "c", float("nan")), (4, "d", None)],
        "k int, s string, x double",
    )
    assert [row.k for row in drop_nulls(df).collect()] == [1]
    assert [row.k for row in drop_nulls(df, ["s"]).collect()] == [1, 3, 4]
    assert as_sets(drop_nulls(df)) == as_sets(df.na.drop())
    assert drop_nulls(df, []).count() == 4


def test_fill_nulls(spark):
    df = spark.createDataFrame([(None, None), ("a", "b")], "s string, t string")
    assert as_sets(fill_nulls(df, {"s": ""})) == Counter([("", None), ("a", "b")])


def test_dedup_keeps_same_key_with_other_values(spark):
    df = spark.createDataFrame(
        [(1, 2, None), (1, 2, None), (1, 3, None), (None, None, None), (None, None, None)],
        "k int, q int, s string",
    )
    expected = Counter([(1, 2, None), (1, 3, None), (None, None, None)])
    assert as_sets(dedup(df)) == expected
    assert as_sets(dedup(dedup(df))) == expected
    assert as_sets(dedup(df.orderBy(F.rand(1)))) == expected
    assert as_sets(drop_nulls(dedup(df), ["k"])) == as_sets(dedup(drop_nulls(df, ["k"])))


def test_distinct_values_keep_null(spark):
    df = spark.createDataFrame([(3,), (4,), (None,), (3,), (None,)], "n int")
    assert distinct_values(df, "n").count() == 3
    assert df.agg(F.count_distinct("n")).collect()[0][0] == 2


def test_typing(spark):
    df = spark.createDataFrame(
        [("1/5/2015", "$90,000 "), ("2015-01-05", "x"), ("n/a", None), (None, "7")],
        "d string, n string",
    )
    got = [tuple(row) for row in type_ints(type_dates(df, "d"), "n").collect()]
    fifth = datetime.date(2015, 1, 5)
    assert got == [(fifth, 90000), (fifth, None), (None, None), (None, 7)]
    assert [tuple(row) for row in date_audit(df, "d").collect()] == [(2, 1, 1)]


def test_mask_columns(spark):
    df = spark.createDataFrame([(1, "ab", 1234), (2, None, None)], "k int, s string, n int")
    names = {"s": "masked_s", "n": "masked_n"}
    assert as_sets(mask_columns(df, names)) == Counter([(1, "**", "****"), (2, None, None)])
    assert mask_columns(df, names, drop_originals=False).columns == [
        "k",
        "s",
        "n",
        "masked_s",
        "masked_n",
    ]


def test_hash_keeps_distinct_values_apart(spark):
    df = spark.range(500).selectExpr("cast(id % 123 as string) AS s")
    hashed = hash_columns(df, ["s"])
    assert distinct_values(hashed, "s").count() == 123
    assert hashed.filter(F.length("s") != 64).count() == 0


def test_sorted_by_puts_nulls_first(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", 4), ("a", 3)], "s string, k int")
    got = [tuple(row) for row in sorted_by(df, "s", tie_breakers=["k"]).collect()]
    assert got == [(None, 2), ("a", 3), ("a", 4), ("b", 1)]


def test_top_k(spark):
    df = spark.createDataFrame([(9, 5.0), (3, 5.0), (1, None), (2, 1.0)], "k int, p double")
    assert [row.k for row in top_k(df, "p", tie_breakers=["k"]).collect()] == [3]
    assert [row.k for row in top_k(df, "p", 4, tie_breakers=["k"]).collect()] == [3, 9, 2, 1]


@pytest.mark.parametrize("k", [1, 2, 3, 5, 8, 60])
def test_top_k_distinct_equals_top_k_after_dedup(spark, k):
    rng = random.Random(k)
    prices = [None, 1.0, 2.0, 2.0, 3.0, 9.0, float("nan")][: 3 + k % 5]
    rows = [(rng.randrange(12), rng.choice(prices), rng.choice("ab")) for _ in range(120)]
    df = spark.createDataFrame(rows, "key int, price double, tag string")
    ties = ["key", "tag"]
    got = [repr(tuple(row)) for row in top_k_distinct(df, "price", k, ties).collect()]
    assert got == [repr(tuple(row)) for row in top_k(dedup(df), "price", k, ties).collect()]
    assert got and len(got) <= k


def test_top_k_distinct_of_nothing_and_of_nulls(spark):
    nulls = spark.createDataFrame([(1, None), (1, None), (2, None)], "key int, price double")
    assert [row.key for row in top_k_distinct(nulls, "price", 5, ["key"]).collect()] == [1, 2]
    assert top_k_distinct(nulls.limit(0), "price").count() == 0


def test_order_counts(sales, sales_rows):
    assert metrics.orders_placed(sales).collect()[0][0] == len({row[1] for row in sales_rows})
    orders = defaultdict(set)
    for row in sales_rows:
        orders[row[0]] |= {row[1]} - {None}
    expected = Counter((date, len(numbers)) for date, numbers in orders.items())
    assert as_sets(metrics.daily_orders(sales)) == expected
    average = metrics.avg_orders_per_day(sales).collect()[0][0]
    assert average == mean(len(numbers) for numbers in orders.values())


def test_unit_means(sales, sales_rows):
    def month(row):
        return row[0] and row[0].month

    cases = {
        metrics.avg_units_per_order: lambda row: row[1],
        metrics.avg_units_per_day: lambda row: row[0],
        metrics.avg_units_per_calendar_month: month,
    }
    for metric, key in cases.items():
        assert metric(sales).collect()[0][0] == mean(summed(sales_rows, key).values())


def test_units_by_year_month(sales, sales_rows):
    got = [tuple(row) for row in metrics.units_by_year_month(sales).collect()]
    totals = summed(sales_rows, lambda row: row[0] and (row[0].year, row[0].month))
    expected = [(None, None, totals.pop(None))] + [(*key, totals[key]) for key in sorted(totals)]
    assert got == expected
    assert sum(row[2] for row in got) == sum(row[3] or 0 for row in sales_rows)


def test_month_pools_years(spark):
    rows = [(datetime.date(2015, 1, 1), "a", 1, 2), (datetime.date(2016, 1, 9), "b", 1, 4)]
    frame = spark.createDataFrame(rows, SALES_DDL)
    assert metrics.avg_units_per_calendar_month(frame).collect()[0][0] == 6.0


def test_lines_by_date(sales, sales_rows):
    got = [tuple(row) for row in metrics.lines_by_date(sales).collect()]
    counts = Counter(row[0] for row in sales_rows)
    assert got == [(None, counts.pop(None))] + [(date, counts[date]) for date in sorted(counts)]


def test_summary_equals_single_metrics(sales):
    summary = metrics.sales_summary(sales).collect()[0].asDict()
    singles = [
        metrics.orders_placed,
        metrics.avg_orders_per_day,
        metrics.avg_units_per_order,
        metrics.avg_units_per_day,
        metrics.avg_units_per_calendar_month,
    ]
    assert summary == {metric.__name__: metric(sales).collect()[0][0] for metric in singles}


def test_metrics_of_no_sales(spark):
    empty = spark.createDataFrame([], SALES_DDL)
    assert tuple(metrics.sales_summary(empty).collect()[0]) == (0, None, None, None, None)
    assert customer_avg_orders_per_day(empty).count() == 0


def test_customer_activity(sales, sales_rows):
    orders = defaultdict(set)
    for row in sales_rows:
        orders[row[2], row[0]] |= {row[1]} - {None}
    counts = defaultdict(list)
    for (customer, _), numbers in orders.items():
        counts[customer].append(len(numbers))
    expected = Counter(
        (customer, date, len(numbers), mean(counts[customer]))
        for (customer, date), numbers in orders.items()
    )
    result = customer_avg_orders_per_day(sales)
    assert as_sets(result) == expected
    # The mean times the active dates is the number of orders.
    for row in (
        result.groupBy("CustomerKey")
        .agg(F.sum("NumOrders").alias("n"), F.sum("AvgOrdersPerDay").alias("m"))
        .collect()
    ):
        assert row.m == pytest.approx(row.n)


def test_activity_ignores_duplicate_sales(sales):
    once = as_sets(customer_avg_orders_per_day(sales))
    assert as_sets(customer_avg_orders_per_day(sales.unionAll(sales))) == once
