"""Batch and streaming sources, and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.operators.ingest import MICROS, decode, to_messages
from murmur.schema import MESSAGE

POSTS = "id string, title string, content string"


def read_messages(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    stream: bool = False,
) -> DataFrame:
    """(topic, partition, offset, key, value) messages, from the earliest offset on.

    ``fmt`` is ``kafka`` or any file format that holds the same columns.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    else:
        reader = reader.schema(MESSAGE)
    reader = reader.options(**(options or {}))
    return decode(reader.load(path) if path else reader.load())


def write_messages(rows: DataFrame, key: str, fmt: str, options: Mapping[str, str], path: str | None = None) -> None:
    """Send rows as JSON messages; any file format stands in for a broker."""
    writer = to_messages(rows, key).write.format(fmt).options(**options).mode("append")
    writer.save(path) if path else writer.save()


def scan(spark: SparkSession, path: str, columns: Sequence[str] = ("*",), fmt: str = "parquet") -> DataFrame:
    """A stored collection, pruned to the columns asked for."""
    return spark.read.format(fmt).load(path).select(*columns)


def copy(rows: DataFrame, path: str, drop: Sequence[str] = ("_id",)) -> None:
    """Append a collection to another store without its internal columns."""
    rows.drop(*drop).write.mode("append").parquet(path)


def read_posts(spark: SparkSession, path: str, schema: str = POSTS) -> DataFrame:
    """Posts of JSON files that hold one array each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Lexicon lines ``word,category,seq``; later ``seq`` wins."""
    return spark.read.schema("word string, category string, seq bigint").option("header", True).csv(path)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, for stopwords."""
    return spark.read.text(path).select(F.col("value").alias("word")).filter("word != ''")


def export_csv(report: DataFrame, path: str) -> None:
    """One flat report as CSV with a header, for spreadsheets: quotes are doubled, times keep microseconds."""
    report.write.mode("overwrite").options(header=True, escape='"', **MICROS).csv(path)


def write_append(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows without looking for earlier ones."""
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite(rows: DataFrame, path: str) -> None:
    """Replace a whole table."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def replace_partitions(rows: DataFrame, path: str, partition_by: Sequence[str] = ("publish_date",)) -> None:
    """Replace only the partitions that ``rows`` has.

    Rebalanced by partition first: rows of a small day come together in one file,
    and a day too large for one task is split over several.
    """
    rows.hint("rebalance", *partition_by).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partition_by).parquet(path)


def write_jdbc(rows: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    """Full refresh of a database table that keeps its definition."""
    rows.write.mode("overwrite").option("truncate", True).jdbc(url, table, properties=dict(properties))
