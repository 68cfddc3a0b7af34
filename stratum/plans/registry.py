"""Query registry: key -> (builder over a ``Shop``, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixtures import Shop


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Shop], DataFrame]
    oracle: str | None
    op_id: str


REGISTRY: dict[str, Query] = {}


def register(key: str, op_id: str, oracle: str | None = None):
    def deco(fn: Callable[[Shop], DataFrame]):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, oracle, op_id)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the plan modules fills REGISTRY.
    from . import (analytics_queries, gold_queries, metrics_queries,  # noqa: F401
                   io_queries, quality_queries, silver_queries, star_queries,
                   streaming_queries, temporal_queries)
    return REGISTRY


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return q.build(Shop(spark, sf_dir))
    run.__name__ = q.key
    return run
