from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import tune

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by function name, with the SQL each must agree with where there is one."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, oracle: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            self.queries[fn.__name__] = lambda spark, sf: fn(tune(spark), sf)
            if oracle is not None:
                self.oracles[fn.__name__] = oracle
            return fn

        return register
