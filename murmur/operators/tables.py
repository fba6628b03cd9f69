"""Table maintenance: upsert, insert-if-absent, validation, differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.operators.ingest import first_by_key


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with the rows of ``new`` put in by key.

    A known key takes the new measures, an unknown one is added, and a key that
    ``new`` no longer has stays as it was. ``keys`` are unique on either side, so
    the join has no hot key.
    """
    measures = [c for c in old.columns if c not in keys]
    left = old.select(*keys, F.struct(*measures).alias("_old"))
    right = new.select(*keys, F.struct(*measures).alias("_new"))
    joined = left.join(right, list(keys), "full_outer")
    row = F.when(F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col("_old"))
    return joined.withColumn("_row", row).select(
        *(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in old.columns)
    )


def insert_ignore(
    old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """``old`` plus the rows of ``new`` with unknown keys; the first writer wins."""
    return old.unionByName(absent(old, new, keys, order).select(*old.columns))


def absent(
    old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """First row per key of ``new`` whose key ``old`` does not have."""
    return first_by_key(new, keys, order).join(old.select(*keys), list(keys), "left_anti")


def validate(
    rows: DataFrame, required: Sequence[str], not_null: Sequence[str], not_empty: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and rejected ones; a missing column is an error at once."""
    missing = [c for c in required if c not in rows.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    checks: list[Column] = [F.col(c).isNotNull() for c in not_null]
    checks += [F.coalesce(F.col(c) != "", F.lit(False)) for c in not_empty]
    ok = reduce(lambda a, b: a & b, checks, F.lit(True))
    return rows.filter(ok), rows.filter(~ok)


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unprocessed(source: DataFrame, done: DataFrame, key: str = "url", flag: str | None = None) -> DataFrame:
    """Rows of ``source`` that are not flagged and whose key is not in ``done``.

    Rows without a key stay. ``done`` is read for its key column only, and is not
    made distinct first: both sides then come straight from their shuffle, and
    adaptive execution can split a partition full of rows without a key.
    """
    if flag:
        source = source.filter(~F.coalesce(F.col(flag), F.lit(False)))
    return source.join(done.select(key), key, "left_anti")


def distinct_urls(rows: DataFrame, key: str = "url") -> DataFrame:
    return rows.select(key).distinct()


def exists_lookup(rows: DataFrame, known: DataFrame, key: str = "url") -> tuple[DataFrame, DataFrame]:
    """Rows to update and rows to insert, by whether their key is known."""
    flagged = flag_known(rows, known, key)
    return flagged.filter("_known").drop("_known"), flagged.filter("not _known").drop("_known")


def flag_known(rows: DataFrame, known: DataFrame, key: str = "url") -> DataFrame:
    """``rows`` with ``_known``, whether their key is known: one join for both answers."""
    keys = known.select(key).distinct().withColumn("_known", F.lit(True))
    return rows.join(keys, key, "left").withColumn("_known", F.coalesce("_known", F.lit(False)))


def take(rows: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``, for a run that must end early."""
    return rows.orderBy(*order).limit(n)


def union_sources(*parts: DataFrame) -> DataFrame:
    """All documents of several sources; fields a source lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
