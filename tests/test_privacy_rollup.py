"""Keyed pseudonyms against the standard library, rotation, and roll-ups of distinct counts."""

import hashlib
import hmac as standard

import pytest
from pyspark.sql import functions as F

from tillwork.functions.pseudonyms import pseudonymized, rekeyed, rekeying
from tillwork.operators.rollup import daily_bitmaps, daily_sketches, rolled_up, rolled_up_estimate

KEYS = {1: b"k", 2: b"\x0b" * 20, 3: b"\xaa" * 131, 4: b"x" * 64, 5: b""}
VALUES = ["Hi There", "", "naïve 漢字", "a" * 500, None]


@pytest.fixture(scope="module")
def keys(spark):
    return spark.createDataFrame([*KEYS.items()], "version int, key binary")


@pytest.mark.parametrize("version", KEYS)
def test_equals_the_standard_library(spark, keys, version):
    rows = spark.createDataFrame([(v, v) for v in VALUES], "clear string, hidden string")
    for row in pseudonymized(rows, keys, "hidden", version=version).collect():
        want = None
        if row.clear is not None:
            want = standard.new(KEYS[version], row.clear.encode(), hashlib.sha256).hexdigest()
        assert (row.hidden, row.KeyVersion) == (want, version)


def test_latest_version_is_the_default(spark, keys):
    rows = spark.createDataFrame([("a",)], "v string")
    assert pseudonymized(rows, keys, "v").first().KeyVersion == 5
    for version in (9, None):
        with pytest.raises(ValueError, match="does not name one key"):
            pseudonymized(rows, keys.where("version > 9") if version is None else keys, "v", version=version)
    with pytest.raises(ValueError, match="does not name one key"):
        pseudonymized(rows, keys.union(keys), "v", version=1)


def test_versions_join_only_through_the_mapping(spark, keys):
    clear = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "id int, v string")
    old, new = (pseudonymized(clear, keys, "v", version=n) for n in (1, 2))
    assert old.join(new, "v").count() == 0
    mapping = rekeying(clear.where("id <> 2"), keys, "v", 1, 2)
    assert mapping.count() == 1
    moved = {r.id: (r.v, r.KeyVersion) for r in rekeyed(old, mapping, "v", 2).collect()}
    want = {r.id: (r.v if r.id != 2 else None, 2) for r in new.collect()}
    assert moved == want


def test_no_key_in_the_plan(spark):
    keys = spark.createDataFrame([(1, b"topsecretkey")], "version int, key binary")
    rows = spark.createDataFrame([("a",)], "v string")
    plan = pseudonymized(rows, keys, "v")._jdf.queryExecution().toString()
    assert "topsecretkey" not in plan and b"topsecretkey".hex() not in plan.lower()


SALES = [
    ("2024-01-01", 1), ("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-02", 40000), ("2024-02-01", -5),
    ("2024-02-01", None), (None, 7), ("2024-03-01", None),
]


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(SALES, "day string, CustomerKey long").withColumn(
        "OrderDate", F.to_date("day")
    )


def test_bitmaps_roll_up_exactly(sales):
    days = daily_bitmaps(sales, "CustomerKey")
    rows = rolled_up(days, "n", Month=F.month("OrderDate")).collect()
    assert {(r.Month, r.n) for r in rows} == {(1, 2), (2, 1), (None, 1)}
    assert rolled_up(days, "n", all=F.lit(1)).first().n == 4
    assert rolled_up(daily_bitmaps(sales.limit(0), "CustomerKey"), "n", all=F.lit(1)).count() == 0


def test_days_can_be_added_later(sales):
    parts = [daily_bitmaps(sales.where(f"day {test}"), "CustomerKey") for test in ("<= '2024-01-01'", "> '2024-01-01'")]
    rows = rolled_up(parts[0].union(parts[1]), "n", Month=F.month("OrderDate")).collect()
    assert {(r.Month, r.n) for r in rows} == {(1, 2), (2, 1)}


def test_sketches_keep_their_bound(spark):
    rows = spark.range(60000).selectExpr(
        "date_add(DATE'2024-01-01', cast(id % 31 AS INT)) AS OrderDate", "cast(id * 7919 % 20011 AS STRING) AS key"
    )
    exact = rows.select("key").distinct().count()
    days = daily_sketches(rows, "key")
    (row,) = rolled_up_estimate(days, "n", Month=F.month("OrderDate")).collect()
    assert days.count() == 31 and abs(row.n / exact - 1) <= 0.05


def test_keys_are_shuffled_not_bitmaps(spark):
    """A bitmap has 4 KB however few keys it holds, so a task makes it only where its keys have met."""
    sales = spark.range(0, 4000, 1, 8).selectExpr(
        "date_add(DATE'2024-01-01', cast(id % 7 AS INT)) AS OrderDate", "id * 40000 % 1000000 AS CustomerKey"
    )
    days = daily_bitmaps(sales, "CustomerKey")
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_bitmap_construct_agg") < plan.index("REPARTITION_BY_NUM")
    assert "bitmap_construct_agg" not in plan[plan.index("REPARTITION_BY_NUM") :]
    want = sales.groupBy("OrderDate", F.floor(F.col("CustomerKey") / 32768)).agg(F.count_distinct("CustomerKey"))
    got = days.groupBy("OrderDate", "Block").agg(F.bitmap_count(F.bitmap_or_agg("Bits")).alias("n"))
    assert got.count() == days.count() == want.count()
    assert got.agg(F.sum("n")).first()[0] == sales.distinct().count()
