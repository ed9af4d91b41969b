"""Expressions on hand-written edge values."""

import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from tillwork.functions.categories import band, recode
from tillwork.functions.dates import ISO_DATE, SLASH_DATE, age_years, parse_date
from tillwork.functions.numbers import discounted, profit, to_int
from tillwork.functions.privacy import sha256_hex, stars
from tillwork.functions.text import joined_name, strict_name, text_length


def values(spark, ddl, rows, *columns):
    got = spark.createDataFrame(rows, ddl).select(*columns).collect()
    return [row[0] if len(columns) == 1 else tuple(row) for row in got]


def date(text):
    return None if text is None else datetime.date.fromisoformat(text)


def test_names(spark):
    rows = [("Mr", "a", "b"), (None, "a", "b"), (None, None, None), ("Ms", "a", None)]
    got = values(
        spark, "p string, f string, l string", rows, joined_name("p", "f", "l"), strict_name("f", "l")
    )
    assert got == [("Mr a b", "a b"), ("a b", "a b"), ("", None), ("Ms a", None)]


def test_text_length_counts_characters(spark):
    assert values(spark, "s string", [("abc",), ("",), (None,), ("éü",), ("😀",)], text_length("s")) == [
        3,
        0,
        None,
        2,
        1,
    ]


@pytest.mark.parametrize(
    "text, formats, expected",
    [
        ("1/5/2015", [SLASH_DATE], "2015-01-05"),
        ("01/05/2015", [SLASH_DATE], "2015-01-05"),
        ("12/31/2015", [SLASH_DATE], "2015-12-31"),
        ("2015-01-05", [SLASH_DATE], None),
        ("2015-01-05", [SLASH_DATE, ISO_DATE], "2015-01-05"),
        ("1/5/2015", [ISO_DATE], None),
        ("13/40/2015", [SLASH_DATE, ISO_DATE], None),
        ("2/29/2015", [SLASH_DATE], None),
        ("soon", [SLASH_DATE, ISO_DATE], None),
        ("a/b-c", [SLASH_DATE, ISO_DATE], None),
        ("", [SLASH_DATE, ISO_DATE], None),
        (None, [SLASH_DATE, ISO_DATE], None),
        ("20150105", ["yyyyMMdd"], "2015-01-05"),
        ("5 of 1 2015", ["d 'of' M yyyy"], "2015-01-05"),
        ("1/2015", ["[d/]M/yyyy"], None),
        ("7/1/2015", ["[d/]M/yyyy"], "2015-01-07"),
    ],
)
def test_parse_date(spark, text, formats, expected):
    assert values(spark, "s string", [(text,)], parse_date("s", formats)) == [date(expected)]


def test_separator_guard_changes_no_result(spark):
    texts = ["1/5/2015", "2015-01-05", "1-5-2015", "2015/01/05", " 1/5/2015", "1/5/15", "x", "/-", None]
    rows = [(text,) for text in texts]
    plain = F.coalesce(F.try_to_date("s", SLASH_DATE), F.try_to_date("s", ISO_DATE))
    got = values(spark, "s string", rows, parse_date("s"), plain)
    assert [guarded for guarded, _ in got] == [unguarded for _, unguarded in got]


def test_every_day_is_read_back_from_both_notations(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1890-01-01', DATE'2110-12-31')) AS d")
    texts = days.select(
        "d",
        F.date_format("d", SLASH_DATE).alias("slash"),
        F.date_format("d", "MM/dd/yyyy").alias("padded"),
        F.date_format("d", ISO_DATE).alias("iso"),
    )
    wrong = [~parse_date(name).eqNullSafe(F.col("d")) for name in ("slash", "padded", "iso")]
    assert texts.filter(wrong[0] | wrong[1] | wrong[2]).count() == 0


def test_age(spark):
    rows = [(date("2000-01-01"),), (None,), (date("2020-01-01"),)]
    got = values(spark, "d date", rows, age_years("d", "2020-01-01"))
    assert got == [7305 / 365, None, 0.0]
    as_date = values(spark, "d date", rows, age_years("d", date("2020-01-01")))
    assert as_date == got
    today = values(spark, "d date", [(date("2000-01-01"),)], age_years("d"))[0]
    assert today > 25


@pytest.mark.parametrize(
    "text, expected",
    [
        ("$90,000 ", 90000),
        ("90000.75", 90000),
        ("-12", -12),
        ("$-1,234", -1234),
        ("12 monkeys", None),
        ("abc", None),
        ("", None),
        (None, None),
        ("2147483647", 2147483647),
        ("2147483648", None),
        ("NaN", None),
    ],
)
def test_to_int(spark, text, expected):
    assert values(spark, "s string", [(text,)], to_int("s")) == [expected]


def test_money(spark):
    rows = [(100.0, 40.0), (None, 40.0), (10.0, None)]
    got = values(spark, "p double, c double", rows, discounted("p"), profit("p", "c"))
    assert got == [(90.0, 60.0), (None, None), (9.0, None)]


def test_band(spark):
    rows = [(49999.99,), (50000.0,), (99999.0,), (100000.0,), (None,)]
    assert values(spark, "x double", rows, band("x")) == ["Low", "Medium", "Medium", "High", "High"]
    assert values(spark, "x double", rows, band("x", null_label="None given"))[-1] == "None given"


def test_recode(spark):
    rows = [("Small",), ("Medium",), ("Large",), ("XL",), ("small",), (None,)]
    assert values(spark, "s string", rows, recode("s")) == ["S", "M", "L"] + ["Unknown"] * 3


def test_hash(spark):
    rows = [("abc",), (None,), ("é",)]
    assert values(spark, "s string", rows, sha256_hex("s")) == [
        hashlib.sha256(text.encode()).hexdigest() if text else None for text in ("abc", None, "é")
    ]
    digest = hashlib.sha256(b"1234").hexdigest()
    assert values(spark, "n int", [(1234,), (None,)], sha256_hex("n")) == [digest, None]


def test_salted_hash(spark):
    digest = hashlib.sha256(b"saltabc").hexdigest()
    assert values(spark, "s string", [("abc",)], sha256_hex("s", "salt")) == [digest]
    per_row = values(spark, "s string, k string", [("abc", "salt")], sha256_hex("s", F.col("k")))
    assert per_row == [digest]


def test_stars(spark):
    assert values(spark, "s string", [("abc",), (None,), ("",), ("éü",)], stars("s")) == [
        "***",
        None,
        "",
        "**",
    ]
    assert values(spark, "n int", [(1234,), (None,)], stars("n")) == ["****", None]
