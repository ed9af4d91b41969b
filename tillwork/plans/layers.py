"""Raw, cleansed and curated layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.dates import DATE_FORMATS, SLASH_DATE
from tillwork.operators.activity import customer_avg_orders_per_day
from tillwork.operators.cleanse import dedup, drop_nulls, type_dates
from tillwork.operators.enrich import with_full_name
from tillwork.operators.protect import hash_columns
from tillwork.sources.files import write_table

# What the hashed full name makes superfluous.
IDENTIFYING_COLUMNS = ("FirstName", "LastName", "Prefix", "Gender")


def customers_raw(customers: DataFrame) -> DataFrame:
    """Complete, distinct customers with their full name. Any NULL cell removes the row."""
    return with_full_name(dedup(drop_nulls(customers)))


def customers_cleansed(customers: DataFrame, salt: str | None = None) -> DataFrame:
    """Raw-layer customers with hashed personal data and a typed birth date."""
    hashed = hash_columns(customers_raw(customers), salt=salt).drop(*IDENTIFYING_COLUMNS)
    return type_dates(hashed, "BirthDate", formats=[SLASH_DATE])


def sales_cleansed(sales: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Distinct sales with a typed order date, NULL where the text is in none of the formats."""
    return type_dates(dedup(sales), "OrderDate", formats=formats)


def land_sales(sales: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write cleansed sales as Parquet, one folder per year, and return the table.

    Scanning, deduplicating and typing happen once here; reports over the table read only the
    columns they need. Files are ordered by date and order: a filter on ``OrderYear`` skips folders,
    one on ``OrderDate`` files and pages, and the lines of an order lie together, so metrics by order,
    date or customer shrink in each task before they are shuffled.
    """
    typed = sales_cleansed(sales).withColumn("OrderYear", F.year("OrderDate"))
    return write_table(
        typed, path, mode, partition_by=["OrderYear"], sort_by=["OrderDate", "OrderNumber"]
    )


def build_layers(
    customers: DataFrame,
    sales: DataFrame,
    root: str,
    mode: str = "errorifexists",
    salt: str | None = None,
) -> dict[str, DataFrame]:
    """Write the cleansed and curated tables below ``root`` and return them by name.

    Curated activity is computed from the landed sales. The raw layer, which holds clear personal
    data, is not stored.
    """
    landed = land_sales(sales, f"{root}/cleansed/sales", mode)
    return {
        "customers": write_table(
            customers_cleansed(customers, salt), f"{root}/cleansed/customers", mode
        ),
        "sales": landed,
        "customer_activity": write_table(
            customer_avg_orders_per_day(landed), f"{root}/curated/customer_activity", mode
        ),
    }
