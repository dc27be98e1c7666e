"""Names, functions and SQL of the queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from frameloom.catalogue.views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function of Views under its name, with its SQL if there is one."""

    def add(f: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
