"""Registry of queries: a name, a Spark plan over the test tables, and its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str):
    """Register a query under ``name`` with the DuckDB SQL that must give the same rows."""

    def register(run):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        ORACLES[name] = oracle.strip()
        return run

    return register
