"""Where queries over the driver's tables, and their SQL, are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: What bounds a word, for both engines: their own word classes differ.
NOT_WORD = r"[^\p{L}\p{N}_]"


def query(sql: str | None):
    """Registers a query under its function's name, with SQL for the same rows where SQL expresses it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add
