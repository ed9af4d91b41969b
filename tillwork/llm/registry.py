"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwork.session import apply_runtime_conf

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the equivalent SQL if there is one."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(apply_runtime_conf(spark), sf_dir)

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register
