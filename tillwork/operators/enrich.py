"""Derived customer and product columns."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame

from tillwork.functions.categories import band, recode
from tillwork.functions.dates import SLASH_DATE, age_years, parse_date
from tillwork.functions.numbers import discounted, profit, to_amount
from tillwork.functions.text import joined_name, strict_name, text_length

AsOf = str | datetime.date | Column | None


def with_full_name(df: DataFrame) -> DataFrame:
    """Add ``FullName`` of prefix, first and last name, skipping those that are NULL."""
    return df.withColumn("FullName", joined_name("Prefix", "FirstName", "LastName"))


def with_strict_full_name(df: DataFrame) -> DataFrame:
    """Add ``FullName`` of first and last name; NULL if either is."""
    return df.withColumn("FullName", strict_name("FirstName", "LastName"))


def with_age(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Add ``Age`` in fractional years from the text ``BirthDate``; unreadable dates give NULL."""
    return df.withColumn("Age", age_years(parse_date("BirthDate", [SLASH_DATE]), as_of))


def with_income_category(df: DataFrame, null_label: str | None = None) -> DataFrame:
    """Add ``IncomeCategory`` of the amount in ``AnnualIncome``; no amount counts as the top band."""
    return df.withColumn("IncomeCategory", band(to_amount("AnnualIncome"), null_label=null_label))


def with_description_length(df: DataFrame) -> DataFrame:
    """Add ``ProductDescriptionLength`` in characters; NULL stays NULL."""
    return df.withColumn("ProductDescriptionLength", text_length("ProductDescription"))


def with_profit(df: DataFrame) -> DataFrame:
    """Add ``ProductProfit``, price minus cost; NULL if either is."""
    return df.withColumn("ProductProfit", profit("ProductPrice", "ProductCost"))


def with_discounted_price(df: DataFrame) -> DataFrame:
    """Add ``DiscountedPrice``, 90 % of the price; NULL stays NULL."""
    return df.withColumn("DiscountedPrice", discounted("ProductPrice"))


def with_size_category(df: DataFrame) -> DataFrame:
    """Add ``ProductSizeCategory``, S, M or L; any other or missing size is Unknown."""
    return df.withColumn("ProductSizeCategory", recode("ProductSize"))
