"""Rows to JSON messages and back; the same expressions serve batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwork.sources.files import EXACT_TIMES

# Where ``from_json`` leaves a bad text, and the name it is stored under: a stored
# ``_corrupt_record`` would be taken for the reader's own column when the files are read back.
CORRUPT_COLUMN = "_corrupt_record"
MALFORMED_TEXT = "malformed_text"


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON object per row in ``value``; NULL fields are left out, times keep their microseconds.

    ``key`` also emits that column as the message key. Without it messages spread evenly over the
    topic's partitions, whatever the data.
    """
    value = F.to_json(F.struct("*"), EXACT_TIMES).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def raw_messages(messages: DataFrame) -> DataFrame:
    """The message text as it came, in ``value``."""
    return messages.select(F.col("value").cast("string").alias("value"))


def parse_messages(messages: DataFrame, schema: StructType) -> DataFrame:
    """Flatten JSON messages to the schema's columns.

    Missing fields are NULL and extra ones are dropped. A malformed, empty or NULL message becomes a
    row of NULLs.
    """
    data = F.from_json(F.col("value").cast("string"), schema).alias("data")
    return messages.select(data).select("data.*")


def parse_or_quarantine(messages: DataFrame, schema: StructType) -> DataFrame:
    """Like ``parse_messages``, with two more columns to set bad messages aside.

    ``malformed`` is true where the text is not JSON of this schema, and ``malformed_text`` then
    holds that text. A field of the wrong type is malformed too; the fields that did fit are kept. A
    NULL message is not malformed.
    """
    with_corrupt = StructType(list(schema.fields)).add(CORRUPT_COLUMN, "string")
    options = {"columnNameOfCorruptRecord": CORRUPT_COLUMN}
    text = F.col("value").cast("string")
    parsed = messages.select(
        text.alias("value"), F.from_json(text, with_corrupt, options).alias("data")
    )
    broken = F.col(f"data.{CORRUPT_COLUMN}").isNotNull()
    # An empty text parses to nothing at all and leaves no corrupt record.
    blank = F.col("value").isNotNull() & F.col("data").isNull()
    return parsed.select(
        *[F.col("data").getField(name).alias(name) for name in schema.fieldNames()],
        F.when(broken | blank, F.col("value")).alias(MALFORMED_TEXT),
        (broken | blank).alias("malformed"),
    )
