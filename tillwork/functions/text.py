"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwork.functions.columns import as_column


def joined_name(*parts: str | Column, sep: str = " ") -> Column:
    """Join the parts that are present; NULL parts are skipped and the result is never NULL."""
    return F.concat_ws(sep, *parts)


def strict_name(*parts: str | Column, sep: str = " ") -> Column:
    """Join all parts; one NULL part makes the result NULL."""
    first, *rest = map(as_column, parts)
    return F.concat(first, *[piece for part in rest for piece in (F.lit(sep), part)])


def text_length(value: str | Column) -> Column:
    """Number of characters; NULL stays NULL."""
    return F.length(as_column(value))
