"""NULL handling, duplicates and typing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tillwork.functions.dates import DATE_FORMATS, parse_date
from tillwork.functions.numbers import to_int


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep rows without NULL (or NaN) in the given columns, by default all.

    Written as one ``IS NOT NULL`` per column, which reaches the Parquet scan; ``na.drop`` does not.
    """
    types = dict(df.dtypes)
    tests = []
    for name in df.columns if subset is None else subset:
        tests.append(F.col(name).isNotNull())
        if types[name] in ("float", "double"):
            tests.append(~F.isnan(name))
    return df.filter(reduce(and_, tests)) if tests else df


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL per column; each value must have its column's type."""
    return df.na.fill(dict(values))


def dedup(df: DataFrame) -> DataFrame:
    """One row per distinct full row; NULL cells count as equal.

    Copies collapse in each task before the shuffle on the whole row, so a row with very many
    copies does not burden one task.
    """
    return df.dropDuplicates()


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations of the given columns; NULL is one value."""
    return df.select(*columns).distinct()


def type_dates(
    df: DataFrame, *columns: str, formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """Replace text columns by dates; text in none of the formats becomes NULL."""
    return df.withColumns({name: parse_date(name, formats) for name in columns})


def type_ints(df: DataFrame, *columns: str) -> DataFrame:
    """Replace columns by 32-bit ints; text that is no amount becomes NULL.

    Columns that are numbers are cast as they are, and those that are ints stay.
    """
    kinds = {name: df.schema[name].dataType for name in columns}
    return df.withColumns(
        {
            name: F.col(name).try_cast("int") if isinstance(kind, NumericType) else to_int(name)
            for name, kind in kinds.items()
            if kind.typeName() != "integer"
        }
    )


def date_audit(
    df: DataFrame, column: str, formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """One row: how many cells are parsed, missing (NULL) and unparsed (text in no known format)."""
    parsed = parse_date(column, formats)
    return df.agg(
        F.count(parsed).alias("parsed"),
        F.count_if(F.col(column).isNull()).alias("missing"),
        F.count_if(F.col(column).isNotNull() & parsed.isNull()).alias("unparsed"),
    )
