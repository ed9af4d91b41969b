"""Banding and recoding expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwork.functions.columns import as_column

# Income bands, each below its bound, and the label from the last bound upwards.
INCOME_BANDS = ((50000, "Low"), (100000, "Medium"))
TOP_INCOME_BAND = "High"

# Size codes, and the code of any other size.
SIZE_CODES = {"Small": "S", "Medium": "M", "Large": "L"}
OTHER_SIZE_CODE = "Unknown"


def band(
    value: str | Column,
    bounds: Sequence[tuple[float, str]] = INCOME_BANDS,
    otherwise: str = TOP_INCOME_BAND,
    null_label: str | None = None,
) -> Column:
    """Label of the first bound, in ascending order, that a *numeric* value lies below.

    NULL lies below no bound and so gets ``otherwise``, unless ``null_label`` names another label.
    """
    number = as_column(value)
    label = F.lit(otherwise)
    for bound, name in reversed(bounds):
        label = F.when(number < bound, name).otherwise(label)
    if null_label is not None:
        label = F.when(number.isNull(), null_label).otherwise(label)
    return label


def recode(
    value: str | Column,
    codes: Mapping[str, str] = SIZE_CODES,
    otherwise: str = OTHER_SIZE_CODE,
) -> Column:
    """Code of an exactly matching value; other values and NULL get ``otherwise``."""
    text = as_column(value)
    known = [F.when(text == old, new) for old, new in codes.items()]
    return F.coalesce(*known, F.lit(otherwise))
