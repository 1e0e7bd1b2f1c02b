"""Registered queries: name -> (Spark callable, equivalent SQL or none)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, wide: tuple[str, ...] = ()
          ) -> Callable[[Query], Query]:
    """Register a query. `wide` names 32-bit columns to give as the 64-bit integers the
    reports (and the SQL) use."""
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(spark, sf_dir)
            return out.withColumns({c: F.col(c).cast("bigint") for c in wide}) if wide else out

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
