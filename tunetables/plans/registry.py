"""Queries by name, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetables.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is defined twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return add


def r6(c: Column | str) -> Column:
    """Six places, so that sums in another order compare equal; no -0.0."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def text_of(c: Column | str) -> Column:
    """An array as text, for results compared by value."""
    return F.array_join(F.col(c) if isinstance(c, str) else c, " ")
