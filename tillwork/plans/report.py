"""The sales report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators.cleanse import dedup
from tillwork.operators.enrich import AsOf
from tillwork.operators.metrics import lines_by_date, sales_summary, units_by_year_month
from tillwork.operators.ordering import sorted_by, top_k, top_k_distinct
from tillwork.plans.enrichment import customers_masked
from tillwork.sources.files import write_table

# The label of each metric in the text report.
LABELS = {
    "orders_placed": "Orders placed",
    "avg_orders_per_day": "Average orders placed in a day",
    "avg_units_per_order": "Average units per order",
    "avg_units_per_day": "Average units per day",
    "avg_units_per_calendar_month": "Average units per calendar month",
    "highest_product_price": "Highest product price",
}


def highest_priced(products: DataFrame, k: int = 1) -> DataFrame:
    """The k distinct products with the highest price; ties go to the lowest key."""
    return top_k_distinct(products, "ProductPrice", k, tie_breakers=["ProductKey"])


def products_by_name(products: DataFrame) -> DataFrame:
    """Distinct products in name order, then by key."""
    return sorted_by(dedup(products), "ProductName", tie_breakers=["ProductKey"])


def scalar_metrics(sales: DataFrame, products: DataFrame) -> DataFrame:
    """One row ``(metric, value)`` per scalar of the report, over cleansed sales."""
    summary = sales_summary(sales)
    values = summary.select([F.col(name).cast("double") for name in summary.columns])
    price = products.agg(F.max("ProductPrice").alias("highest_product_price"))
    return values.unpivot([], values.columns, "metric", "value").unionAll(
        price.unpivot([], price.columns, "metric", "value")
    )


def text_lines(metrics: DataFrame) -> DataFrame:
    """The metrics as lines ``label: value`` with two decimals; an unknown metric keeps its name."""
    label = F.coalesce(
        *[F.when(F.col("metric") == name, text) for name, text in LABELS.items()],
        F.col("metric"),
    )
    return metrics.select(F.format_string("%s: %.2f", label, F.col("value")).alias("line"))


def write_report(
    sales: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    root: str,
    mode: str = "errorifexists",
    as_of: AsOf = None,
) -> dict[str, DataFrame]:
    """Write every part of the report as a table below ``root`` and return them by name.

    ``sales`` are cleansed; pass the landed table, since three parts scan them. The raw products are
    read once, for the table in name order; the other parts about products come from that table.
    """
    by_name = write_table(products_by_name(products), f"{root}/products_by_name", mode)
    parts = {
        "metrics": scalar_metrics(sales, by_name),
        "units_by_year_month": units_by_year_month(sales),
        "lines_by_date": lines_by_date(sales),
        "highest_priced_product": top_k(by_name, "ProductPrice", tie_breakers=["ProductKey"]),
        "customers_masked": customers_masked(customers, as_of),
    }
    written = {name: write_table(part, f"{root}/{name}", mode) for name, part in parts.items()}
    return written | {"products_by_name": by_name}
