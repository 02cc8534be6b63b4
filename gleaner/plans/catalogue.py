"""The whole catalogue; importing the query modules fills the registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleaner.plans import (  # noqa: F401
    file_queries, note_queries, registry, run_queries, source_queries, stream_queries, text_queries,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return registry.callables()


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLES)
