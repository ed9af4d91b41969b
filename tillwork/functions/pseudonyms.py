"""Keyed pseudonyms: HMAC-SHA-256 under versioned keys.

A plain hash of an e-mail address can be found by hashing all addresses; without the key a pseudonym
cannot. Keys come as a table (``version`` int, ``key`` binary), so none stands in a query's text, and
everything is computed by Spark's own functions. Pseudonyms of different versions share nothing: tables
that hold them join only through ``rekeying``, which needs the clear values once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The block of SHA-256 in bytes, and the two paddings of HMAC.
BLOCK, INNER, OUTER = 64, 0x36, 0x5C
#: Versions a key table may have; it is broadcast.
MOST_VERSIONS = 1000


def _padded(key: Column, byte: int) -> Column:
    """The key, or its digest if it is longer than a block, filled with zeros, every byte XORed."""
    digits = F.rpad(F.hex(key), 2 * BLOCK, "0")

    def xored(i: Column) -> Column:
        value = F.conv(F.substring(digits, 2 * i + 1, F.lit(2)), 16, 10).cast("int")
        return F.lpad(F.hex(value.bitwiseXOR(F.lit(byte))), 2, "0")

    return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BLOCK - 1)), xored), ""))


def paddings(keys: DataFrame) -> DataFrame:
    """``version``, ``_inner`` and ``_outer`` of every key."""
    long = F.octet_length("key") > BLOCK
    key = F.when(long, F.unhex(F.sha2(F.col("key"), 256))).otherwise(F.col("key"))
    return keys.select("version", _padded(key, INNER).alias("_inner"), _padded(key, OUTER).alias("_outer"))


def hmac(value: Column) -> Column:
    """Lower-case hexadecimal HMAC of a value's UTF-8 bytes beside ``paddings``; NULL stays NULL."""
    inner = F.unhex(F.sha2(F.concat("_inner", value.cast("string").cast("binary")), 256))
    return F.sha2(F.concat("_outer", inner), 256)


def _key(keys: DataFrame, version: int | None) -> DataFrame:
    """The paddings of one version, the latest by default: one row, small enough to broadcast."""
    if keys.limit(MOST_VERSIONS + 1).count() > MOST_VERSIONS:
        raise ValueError(f"more than {MOST_VERSIONS} key versions")
    chosen = keys.agg(F.max("version")).first()[0] if version is None else version
    one = paddings(keys.where(F.col("version") == chosen))
    if one.count() != 1:
        raise ValueError(f"version {chosen} does not name one key")
    return one


def pseudonymized(df: DataFrame, keys: DataFrame, *columns: str, version: int | None = None) -> DataFrame:
    """Replace columns by their pseudonyms under one version of the key, and add ``KeyVersion``."""
    joined = df.join(F.broadcast(_key(keys, version).withColumnRenamed("version", "KeyVersion")))
    return joined.withColumns({name: hmac(F.col(name)) for name in columns}).select(*df.columns, "KeyVersion")


def rekeying(clear: DataFrame, keys: DataFrame, column: str, old: int, new: int) -> DataFrame:
    """``Old`` and ``New`` pseudonym of every distinct clear value."""
    values = clear.select(column).where(F.col(column).isNotNull()).distinct()
    before = pseudonymized(values.withColumn("Old", F.col(column)), keys, "Old", version=old)
    both = before.drop("KeyVersion").withColumn("New", F.col(column))
    return pseudonymized(both, keys, "New", version=new).select("Old", "New")


def rekeyed(df: DataFrame, mapping: DataFrame, column: str, new: int) -> DataFrame:
    """Pseudonyms of a table translated by a mapping; one that it lacks becomes NULL, as it can no
    longer be told whose it is."""
    joined = df.join(mapping, F.col(column) == F.col("Old"), "left")
    kept = [F.col("New").alias(c) if c == column else F.col(c) for c in df.columns if c != "KeyVersion"]
    return joined.select(*kept, F.lit(new).alias("KeyVersion"))
