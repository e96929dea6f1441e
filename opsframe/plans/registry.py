"""Queries by name, each next to the SQL it must agree with."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under the name of its function."""

    def register(func: Query) -> Query:
        @functools.wraps(func)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # All times are UTC without a zone.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return func(spark, sf_dir.rstrip("/"))

        name = func.__name__
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return run

    return register
