"""Customer and product views with derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwork.operators.cleanse import fill_nulls, type_ints
from tillwork.operators.enrich import (
    AsOf,
    with_age,
    with_description_length,
    with_discounted_price,
    with_full_name,
    with_income_category,
    with_profit,
    with_size_category,
    with_strict_full_name,
)
from tillwork.operators.protect import mask_columns
from tillwork.sources.files import write_json, write_table

# The columns a full name is made of, and what stands for a missing value.
NAME_PARTS = ("Prefix", "FirstName", "LastName")
CUSTOMER_FILL = {"EmailAddress": ""}
PRODUCT_FILL = {"ProductColor": "", "ProductSize": ""}


def customers_curated(customers: DataFrame) -> DataFrame:
    """Customers with no NULL e-mail address, numeric income and children, and a strict full name."""
    filled = fill_nulls(customers, CUSTOMER_FILL)
    return with_strict_full_name(type_ints(filled, "AnnualIncome", "TotalChildren"))


def products_curated(products: DataFrame) -> DataFrame:
    """Products with no NULL color or size, and the discounted price."""
    return with_discounted_price(fill_nulls(products, PRODUCT_FILL))


def customers_enriched(
    customers: DataFrame, as_of: AsOf = None, null_label: str | None = None
) -> DataFrame:
    """Customers with full name, age and income band."""
    return with_income_category(with_age(with_full_name(customers), as_of), null_label)


def products_profiled(products: DataFrame) -> DataFrame:
    """Products with description length and profit."""
    return with_profit(with_description_length(products))


def products_sized(products: DataFrame) -> DataFrame:
    """Products with discounted price and size code."""
    return with_size_category(with_discounted_price(products))


def products_enriched(products: DataFrame) -> DataFrame:
    """Products with all derived columns of the two views above."""
    return products_sized(products_profiled(products))


def customers_masked(
    customers: DataFrame, as_of: AsOf = None, drop_originals: bool = True
) -> DataFrame:
    """Customers with age, and starred personal data in place of the clear text.

    The full name is starred, and its parts go with the other clear text. The birth date and the other
    columns stay.
    """
    named = with_age(with_full_name(customers), as_of)
    masked = mask_columns(named, drop_originals=drop_originals)
    return masked.drop(*NAME_PARTS) if drop_originals else masked


def write_views(
    customers: DataFrame,
    products: DataFrame,
    root: str,
    mode: str = "errorifexists",
    as_of: AsOf = None,
    products_json: str | None = None,
) -> dict[str, DataFrame]:
    """Write the curated and enriched views as tables below ``root`` and return them by name.

    The products are landed first and read once; ``products_json`` also exports them as JSON Lines.
    """
    landed = write_table(products, f"{root}/products", mode)
    if products_json is not None:
        write_json(landed, products_json, mode)
    views = {
        "customers_curated": customers_curated(customers),
        "customers_enriched": customers_enriched(customers, as_of),
        "products_curated": products_curated(landed),
        "products_enriched": products_enriched(landed),
    }
    written = {name: write_table(view, f"{root}/{name}", mode) for name, view in views.items()}
    return written | {"products": landed}
