"""The registered queries of the genomic operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a function as a query under its name, with the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def queries() -> dict[str, Query]:
    from flankspark.jobs import exchange, flanks, formats, loci, tables  # noqa: F401  they register their queries

    return dict(sorted(QUERIES.items()))


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(sorted(ORACLES.items()))
