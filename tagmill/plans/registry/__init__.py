"""Registered queries: name -> (Spark query, DuckDB text or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _modules():
    from tagmill.plans.registry import catalog_queries, dataset_queries, request_queries, stream_queries, tag_queries

    return [tag_queries, catalog_queries, dataset_queries, request_queries, stream_queries]


def all_queries() -> dict[str, tuple[Query, str | None]]:
    found: dict[str, tuple[Query, str | None]] = {}
    for module in _modules():
        overlap = found.keys() & module.QUERIES.keys()
        if overlap:
            raise ValueError(f"registered twice: {sorted(overlap)}")
        found.update(module.QUERIES)
    return found
