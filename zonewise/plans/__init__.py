"""The registered queries: each pairs a Spark plan over the given tables with the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


class Registry:
    """Collects the queries of one module."""

    def __init__(self) -> None:
        self.queries: list[Query] = []

    def add(self, oracle: str | None = None):
        def register(build):
            self.queries.append(Query(build.__name__, build, oracle))
            return build
        return register


def all_queries() -> list[Query]:
    from zonewise.plans import clusters, files, readings, reports, streams, workers, zones
    modules = (zones, readings, workers, reports, clusters, files, streams)
    found = [query for module in modules for query in module.registry.queries]
    names = [q.name for q in found]
    if len(set(names)) != len(names):
        raise ValueError("two queries share a name")
    return found
