"""The queries of the operators by name, each with its check SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register a function of (session, table folder) under ``name``."""

    def register(fn):
        QUERIES[name] = fn
        if check:
            CHECKS[name] = check
        return fn

    return register
