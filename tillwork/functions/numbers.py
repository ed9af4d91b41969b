"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwork.functions.columns import as_column

# What may decorate an amount written as text.
AMOUNT_DECORATION = "$€£¥, \t"

# Fixed value: the discounted price is this share of the list price.
DISCOUNT_FACTOR = 0.9


# Fixed value: an amount without its decoration. Exponents, hexadecimal and type suffixes, which a
# cast to double takes, are no amounts.
PLAIN_AMOUNT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"


def to_amount(value: str | Column) -> Column:
    """Amount text such as ``$90,000`` to a decimal.

    Currency signs, thousands commas and blanks are ignored. NULL, any other text and numbers of more
    than 28 digits before the point give NULL (never an error).
    """
    text = F.translate(as_column(value).cast("string"), AMOUNT_DECORATION, "")
    return F.when(text.rlike(PLAIN_AMOUNT), text).try_cast("decimal(38,10)")


def to_int(value: str | Column) -> Column:
    """Like ``to_amount``, to a 32-bit int: fractions are cut off, numbers beyond it give NULL."""
    return to_amount(value).try_cast("int")


def discounted(price: str | Column, factor: float = DISCOUNT_FACTOR) -> Column:
    """Price after discount; NULL stays NULL."""
    return as_column(price) * F.lit(factor)


def profit(price: str | Column, cost: str | Column) -> Column:
    """Price minus cost; NULL if either is."""
    return as_column(price) - as_column(cost)
