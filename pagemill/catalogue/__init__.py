"""Named queries over the driver tables, each with the SQL that gives the same answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> tuple[dict[str, Query], dict[str, str]]:
    """Import every query module and return the registered queries and oracles."""
    from pagemill.catalogue import (  # noqa: F401
        content_queries, enrich_queries, graph_queries, network_queries, policy_queries, record_queries, text_queries,
        url_queries,
    )

    return dict(QUERIES), dict(ORACLES)
