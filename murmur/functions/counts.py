"""Counting the elements of an array where it is, without rows: sorted, equal ones stand together."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmur.functions.bind import once


def _starts(s: Column, key) -> Column:
    """Places in the sorted array where another key begins, from 0."""
    place = F.sequence(F.lit(0), F.size(s) - 1)
    new = lambda i: (i == 0) | ~key(F.get(s, i)).eqNullSafe(key(F.get(s, i - 1)))
    return F.filter(place, lambda i: (i >= 0) & (i < F.size(s)) & new(i))  # an empty array gives 0 and -1


def occurrences(items: Column) -> Column:
    """(item, n) for each distinct element of an array."""

    def counted(s):
        def of(starts):
            end = lambda k: F.coalesce(F.get(starts, k + 1), F.size(s))
            return F.transform(starts, lambda i, k: F.struct(F.get(s, i).alias("item"), (end(k) - i).cast("bigint").alias("n")))

        return once(_starts(s, lambda x: x), of)

    return once(F.sort_array(items), counted)


def with_counts(pairs: Column) -> Column:
    """(idx, name, tag, n) for each element (name, tag) of an array, in order; ``n`` is how often the array has the name."""

    def counted(s):
        def of(starts):
            end = lambda k: F.coalesce(F.get(starts, k + 1), F.size(s))

            def group(i, k):
                n = (end(k) - i).cast("bigint")
                return F.transform(
                    F.slice(s, i + 1, end(k) - i), lambda x: F.struct(x["idx"].alias("idx"), x["name"].alias("name"), x["tag"].alias("tag"), n.alias("n"))
                )

            return F.sort_array(F.flatten(F.transform(starts, group)))

        return once(_starts(s, lambda x: x["name"]), of)

    placed = F.transform(pairs, lambda x, i: F.struct(x["name"].alias("name"), i.alias("idx"), x["tag"].alias("tag")))
    return once(F.sort_array(placed), counted)
