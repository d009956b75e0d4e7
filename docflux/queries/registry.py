"""Registration of a module's queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docflux.sources.tables import arrival, table

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """The tables of one folder, by name; ``arrival`` gives a table with the order in which its rows were written."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def arrival(self, name: str) -> DataFrame:
        return arrival(self.spark, self.sf_dir, name)


def registry() -> tuple[Callable[[str | None], Callable], dict[str, Query], dict[str, str]]:
    """(query, queries, sql): a decorator with the SQL of equal rows (None where there is none), and what it registers.

    The decorated function gets a loader of tables and the session, and is registered under its own name.
    """
    queries: dict[str, Query] = {}
    sql: dict[str, str] = {}

    def query(text: str | None) -> Callable:
        def add(fn: Callable) -> Callable:
            name = fn.__name__.strip("_")
            queries[name] = lambda spark, d: fn(Tables(spark, d), spark)
            if text:
                sql[name] = text
            return fn

        return add

    return query, queries, sql
