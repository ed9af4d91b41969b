"""Declared schemas of the retail entities. Every field is nullable.

``PhoneNumber`` is a string: an integer would turn formatted and long numbers into NULL.
"""

from __future__ import annotations

from pyspark.sql.types import StructType


def table_schema(fields: str) -> StructType:
    """Schema from ``name type`` pairs separated by commas; needs no running session."""
    schema = StructType()
    for field in fields.split(","):
        name, type_name = field.split()
        schema = schema.add(name, type_name, nullable=True)
    return schema


def all_strings(columns: list[str]) -> StructType:
    """Schema of a header-only text source: the given names, every field a string."""
    schema = StructType()
    for name in columns:
        schema = schema.add(name, "string", nullable=True)
    return schema


# The fields of the four entities.
CUSTOMERS = table_schema(
    "CustomerKey integer, Prefix string, FirstName string, LastName string, BirthDate string, "
    "MaritalStatus string, Gender string, EmailAddress string, AnnualIncome string, "
    "TotalChildren integer, EducationLevel string, Occupation string, HomeOwner string, "
    "PhoneNumber string, Address string"
)
PRODUCTS = table_schema(
    "ProductKey integer, ProductSubcategoryKey integer, ProductName string, "
    "ProductDescription string, ProductColor string, ProductSize string, ProductCost double, "
    "ProductPrice double"
)
RETURNS = table_schema(
    "ReturnDate string, TerritoryKey integer, ProductKey integer, ReturnQuantity integer"
)
SALES = table_schema(
    "OrderDate string, StockDate string, OrderNumber string, ProductKey integer, "
    "CustomerKey integer, TerritoryKey integer, OrderLineItem integer, OrderQuantity integer"
)
