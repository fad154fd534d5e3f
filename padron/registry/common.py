"""Registration of queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracle: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            self.queries[fn.__name__] = fn
            if sql:
                self.oracle[fn.__name__] = sql
            return fn

        return register
