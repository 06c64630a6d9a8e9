"""One registry of named queries: Spark builder plus the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self._queries: dict[str, Builder] = {}
        self._sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
        def add(build: Builder) -> Builder:
            if name in self._queries:
                raise ValueError(f"{name} is registered twice")
            self._queries[name] = build
            if sql is not None:
                self._sql[name] = sql
            return build

        return add

    def queries(self) -> dict[str, Builder]:
        return dict(self._queries)

    def oracle_sql(self) -> dict[str, str]:
        return dict(self._sql)
