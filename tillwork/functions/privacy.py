"""Pseudonymisation and masking expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwork.functions.columns import as_column


def sha256_hex(value: str | Column, salt: str | Column | None = None) -> Column:
    """SHA-256 of the value as text, 64 hex characters; NULL stays NULL.

    Any type is cast to string first. A string ``salt`` is a literal and a Column salt is evaluated
    per row; it is put in front of the value. Without a salt, guessable values such as phone numbers
    can be found again by hashing all candidates.
    """
    text = as_column(value).cast("string")
    if salt is not None:
        text = F.concat(F.lit(salt) if isinstance(salt, str) else salt.cast("string"), text)
    return F.sha2(text, 256)


def stars(value: str | Column) -> Column:
    """One ``*`` per character of the value as text; NULL stays NULL."""
    return F.repeat(F.lit("*"), F.length(as_column(value).cast("string")))

