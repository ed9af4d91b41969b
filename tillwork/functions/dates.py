"""Date expressions."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwork.functions.columns import as_column

# The two date notations of the sales and customer files.
SLASH_DATE = "M/d/yyyy"
ISO_DATE = "yyyy-MM-dd"
DATE_FORMATS = (SLASH_DATE, ISO_DATE)

# Fixed value: an age is days divided by this, so leap days let it drift.
DAYS_PER_YEAR = 365


def parse_date(value: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text to date by the first format that fits; NULL if none does (never an error).

    A failed parse costs several times a good one, so a format is tried only on text that has its
    separators.
    """
    text = as_column(value)
    return F.coalesce(*[_parse_if_plausible(text, fmt) for fmt in formats])


def _parse_if_plausible(text: Column, fmt: str) -> Column:
    parsed = F.try_to_date(text, fmt)
    separators = {char for char in fmt if not char.isalpha()}
    # Quotes, optional parts and padding would make the separators more than plain text.
    if not separators or separators & set("'[]{}#"):
        return parsed
    present = [F.contains(text, F.lit(char)) for char in sorted(separators)]
    return F.when(reduce(and_, present), parsed)


def age_years(born: str | Column, as_of: str | datetime.date | Column | None = None) -> Column:
    """Age in fractional years, days / 365; NULL birth date gives NULL.

    ``as_of`` is a date, an ISO string or a Column; the default is the day the query runs.
    """
    if as_of is None:
        today = F.current_date()
    elif isinstance(as_of, Column):
        today = as_of
    else:
        today = F.lit(as_of).cast("date")
    return F.datediff(today, born) / DAYS_PER_YEAR
