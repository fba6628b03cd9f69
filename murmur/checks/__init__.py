"""Registered queries over the given tables, each beside the SQL that checks it."""

from murmur.checks import aggregates, ingest, nested, scalars, streams, words  # noqa: F401
from murmur.checks.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
