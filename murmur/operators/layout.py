"""Where rows lie: sizes Catalyst estimates, and moving whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame

SPREAD_BYTES = 32 * 1024 * 1024
PART_BYTES = 64 * 1024 * 1024


def estimated_bytes(rows: DataFrame) -> int:
    """Size of the optimised plan's output as Catalyst estimates it; runs no job."""
    stats = rows._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def spread(docs: DataFrame, key: str) -> DataFrame:
    """Deal documents out to all cores, in parts of at most some 32 MB of the files they are read from.

    A row group is read by one task, which would then tokenise everything alone, however large it is.
    Streams stay where they are. ``key`` identifies a document.
    """
    if docs.isStreaming:
        return docs
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs.repartition(max(cores, min(-(-read_bytes(docs) // SPREAD_BYTES), 200_000)), key)


def by_document(docs: DataFrame, doc: str) -> DataFrame:
    """Move whole documents, not their tokens, to the task that will group them.

    Grouping and ranking by ``doc`` and anything else then needs no further shuffle.
    The number of partitions is given, as a size measured at run time would be that of
    the documents and not of the many rows they turn into: that of the session, or
    more where the tables read hold more than that many parts of 64 MB.
    """
    return docs.repartition(partitions(docs), doc)


def read_bytes(rows: DataFrame) -> int:
    """Bytes of the tables that are read, as far as they are known."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 60)  # the rest, streams among them, have no estimate


def partitions(rows: DataFrame) -> int:
    """Number of partitions for the bytes of the tables that are read, the session's at least."""
    held = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(held, min(read_bytes(rows) // PART_BYTES, 200_000))
