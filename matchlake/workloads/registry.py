"""All registered queries and the SQL texts that check them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchlake.workloads import gold_queries, intake_queries, page_queries, refine_queries, season_queries, storage_queries

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (gold_queries, refine_queries, page_queries, storage_queries, intake_queries, season_queries)


def queries() -> dict[str, Query]:
    return {key: query for module in _MODULES for key, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {key: sql for module in _MODULES for key, sql in module.ORACLES.items()}
