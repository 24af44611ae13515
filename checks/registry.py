"""One entry per query: the Spark side and, where SQL can say it, the SQL side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(build):
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle
        return build

    return add
