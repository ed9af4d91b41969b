"""Deliveries: what they add, what they leave alone, conflicts and interrupted writers."""

import os

import pytest
from pyspark.sql import functions as F

from tillwork import schemas
from tillwork.operators.activity import customer_avg_orders_per_day
from tillwork.plans import incremental
from tillwork.plans.incremental import customer_activity, deliver_activity, deliver_sales, landed_sales
from tillwork.plans.layers import sales_cleansed
from tillwork.sources.versions import VersionConflict, VersionedTables


def line(date, order, customer=1, item=1):
    return (date, "1/1/2015", order, 1, customer, 1, item, 2)


FIRST = [line("1/5/2015", "a"), line("1/5/2015", "a"), line("2/5/2016", "b"), line("bad", "c"), line(None, None)]
SECOND = [line("1/5/2015", "a"), line("1/5/2015", "a", item=2), line("bad", "c"), line("3/5/2017", "d", None)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def frame(spark):
    return lambda lines: spark.createDataFrame(lines, schemas.SALES)


def files(root):
    return {
        os.path.join(at, name): os.stat(os.path.join(at, name)).st_mtime_ns
        for at, _, names in os.walk(f"{root}/sales")
        for name in names
        if name.endswith(".parquet")
    }


def test_two_deliveries_equal_one(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    deliver_sales(frame(FIRST), root)
    before = files(root)
    both = deliver_sales(frame(SECOND), root)
    assert rows(both) == rows(sales_cleansed(frame(FIRST + SECOND)))
    after = files(root)
    assert before.items() <= after.items()
    added = sorted(path.split("_part=")[1].split("/")[0] for path in after.keys() - before.keys())
    assert added == ["2015", "2017"]
    assert rows(landed_sales(spark, root, both.schema, [2017])) == rows(both.where(F.year("OrderDate") == 2017))


def test_nothing_new_makes_no_version(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    deliver_sales(frame(FIRST), root)
    deliver_sales(frame(FIRST), root)
    deliver_sales(frame([]), root)
    assert VersionedTables(spark, root).latest()[0] == 1


def test_empty_first_delivery(spark, frame, tmp_path):
    assert deliver_sales(frame([]), str(tmp_path / "t")).count() == 0


def test_years_are_read_alone(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    schema = deliver_sales(frame(FIRST), root).schema
    assert {f.split("_part=")[1].split("/")[0] for f in landed_sales(spark, root, schema, [2016]).inputFiles()} == {"2016"}


def test_an_interrupted_delivery_is_not_seen(spark, frame, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    landed = rows(deliver_sales(frame(FIRST), root))
    schema = sales_cleansed(frame(FIRST)).schema

    def lost(self, version, listing):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTables, "commit", lost)
        with pytest.raises(RuntimeError):
            deliver_sales(frame(SECOND), root)
    assert rows(landed_sales(spark, root, schema)) == landed
    both = deliver_sales(frame(SECOND), root)
    assert rows(both) == rows(sales_cleansed(frame(FIRST + SECOND)))


def test_two_writers_cannot_both_end(spark, tmp_path):
    tables = VersionedTables(spark, str(tmp_path / "t"))
    assert tables.commit(0, {"x": {}}) == 1
    with pytest.raises(VersionConflict):
        tables.commit(0, {"y": {}})
    assert tables.latest() == (1, {"x": {}})


def activity_of(spark, frame, lines):
    return rows(customer_avg_orders_per_day(sales_cleansed(frame(lines))))


def test_activity_equals_the_full_job(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    more = [line("1/5/2015", "e"), line("1/9/2015", "f"), line("3/5/2017", None, 2)]
    wrong = [line("2/5/2016", "z", 2), line("1/5/2015", "a", item=9)]
    typed = {name: sales_cleansed(frame(lines)) for name, lines in (("1", FIRST), ("2", more + wrong), ("x", wrong))}
    deliver_activity(typed["1"], root)
    schema = typed["1"].schema
    assert rows(customer_activity(spark, root, schema)) == activity_of(spark, frame, FIRST)
    months = VersionedTables(spark, root).latest()[1]["orders"]
    deliver_activity(typed["2"], root)
    deliver_activity(typed["x"].limit(0), root, removed=typed["x"])
    assert rows(customer_activity(spark, root, schema)) == activity_of(spark, frame, FIRST + more)
    # The undated month was in none of the later deliveries.
    assert VersionedTables(spark, root).latest()[1]["orders"]["none"] == months["none"]


def test_a_month_can_become_empty(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    typed = sales_cleansed(frame([line("1/5/2015", "a")]))
    deliver_activity(typed, root)
    deliver_activity(typed.limit(0), root, removed=typed)
    assert customer_activity(spark, root, typed.schema).count() == 0


def test_a_first_delivery_is_staged_once(frame, tmp_path, monkeypatch):
    staged, stage = [], incremental._staged
    monkeypatch.setattr(incremental, "_staged", lambda df, name: staged.append(name) or stage(df, name))
    deliver_sales(frame(FIRST), str(tmp_path / "t"))
    assert staged == ["delivery"]
    both = deliver_sales(frame(SECOND), str(tmp_path / "t"))
    # What a join with landed rows leaves is staged: finding ranges would join once more.
    assert staged == ["delivery", "delivery", "new-sales"]
    assert rows(both) == rows(sales_cleansed(frame(FIRST + SECOND)))
