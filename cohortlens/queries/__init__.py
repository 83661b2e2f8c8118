"""Registered queries, each with the SQL another engine answers it with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name; SQL is kept apart because not every query has one."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(function: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = function
            if sql is not None:
                self.sql[name] = sql
            return function

        return register


registry = Registry()


def load() -> Registry:
    from cohortlens.queries import clusterings, features, names, profiles, repairs, texts  # noqa: F401

    return registry
