"""Names of queries, their Spark functions and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from murmur.session import SETTINGS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with SQL that gives the same rows.

    A name that is also that of an operator ends in ``_query`` in the code.
    """

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            for key, value in SETTINGS.items():
                spark.conf.set(key, value)
            return fn(spark, sf_dir)

        name = fn.__name__.removesuffix("_query")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add
