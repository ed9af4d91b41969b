"""Sorts and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators.cleanse import dedup


def sorted_by(df: DataFrame, *columns: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Global ascending sort, NULLs first.

    The sort is range-partitioned. Rows equal in all sort columns cannot be split over tasks, so name
    a key in ``tie_breakers`` when one value may hold many rows; it also fixes the order of ties.
    """
    return df.orderBy(*columns, *tie_breakers)


def top_k(df: DataFrame, column: str, k: int = 1, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The k rows with the highest value, NULLs last; ties go to the lowest tie-breaker.

    Each task keeps its own k best rows, so only k rows per task are moved. One task merges them: keep
    k times the number of tasks within what it can hold, or sort and write instead.
    """
    return df.orderBy(F.col(column).desc(), *tie_breakers).limit(k)


def top_k_distinct(
    df: DataFrame, column: str, k: int = 1, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """The top k of the distinct full rows, exactly ``top_k(dedup(df), ...)``.

    None of those rows lies below the k-th highest distinct value, which one column suffices to find.
    So only rows from there upwards are deduplicated, not the whole table; the comparison stands alone
    in its filter, so that it reaches the scan. With fewer than k distinct values the bound is the
    lowest, and rows without a value are candidates too.
    """
    known = df.select(column).filter(F.col(column).isNotNull()).distinct()
    highest = top_k(known, column, k)
    bound = highest.agg(F.min(column)).scalar()
    too_few = highest.agg(F.count("*") < k).scalar()
    candidates = df.filter(F.col(column) >= bound).unionAll(
        df.filter(F.col(column).isNull() & too_few)
    )
    return top_k(dedup(candidates), column, k, tie_breakers)
