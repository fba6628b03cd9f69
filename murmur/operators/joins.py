"""Joins against small tables and joins on skewed keys."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.operators.layout import estimated_bytes

SALTS = 16

# A table of at most this size by Catalyst's estimate is sent to every task.
BROADCAST_BYTES = 64 * 1024 * 1024


def literal_table(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """Small table of given rows.

    Built from Arrow it becomes a local relation, so Catalyst knows its exact size
    and broadcasts it without a hint.
    """
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, columns)))))


def salted_lookup(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Join ``rows`` with at most one ``lookup`` row per key, spreading hot keys.

    Every lookup row is repeated once per salt, and each row joins within one salt
    chosen from its whole content. A key that holds a large share of the rows is
    thus shared by ``salts`` tasks. Null keys match nothing.
    """
    salt = F.pmod(F.xxhash64(*(F.col(c) for c in rows.columns)), F.lit(salts)).cast("int")
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        rows.withColumn("_salt", salt).join(repeated, [*keys, "_salt"], how).drop("_salt")
    )


def small_lookup(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Join many ``rows`` with a table that is meant to be small, one row per key.

    The table is broadcast if its size is known to be within ``limit``. Otherwise
    both sides are shuffled, salted, since words and names have hot keys.
    """
    if estimated_bytes(table) <= limit:
        return rows.join(F.broadcast(table), list(keys), how)
    return salted_lookup(rows, table, keys, how)
