"""Personal data: hashing and masking of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from tillwork.functions.privacy import sha256_hex, stars

# The personal columns of a customer, and the names of their masked versions.
PERSONAL_COLUMNS = ("FullName", "EmailAddress", "PhoneNumber", "Address")
MASKED_NAMES = {
    "FullName": "masked_name",
    "EmailAddress": "masked_email",
    "Address": "masked_address",
    "PhoneNumber": "masked_phone",
}


def hash_columns(
    df: DataFrame,
    columns: Sequence[str] = PERSONAL_COLUMNS,
    salt: str | Column | None = None,
) -> DataFrame:
    """Replace columns by their SHA-256 hex digest; NULL stays NULL."""
    return df.withColumns({name: sha256_hex(name, salt) for name in columns})


def mask_columns(
    df: DataFrame,
    names: Mapping[str, str] = MASKED_NAMES,
    drop_originals: bool = True,
) -> DataFrame:
    """Add starred copies of columns, ``{column: masked name}``; NULL stays NULL.

    The clear text is dropped unless ``drop_originals`` is false.
    """
    masked = df.withColumns({new: stars(old) for old, new in names.items()})
    return masked.drop(*names) if drop_originals else masked
