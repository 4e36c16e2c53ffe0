"""Registration of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import Catalog


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Catalog], DataFrame]
    sql: str | None
    covers: tuple[str, ...]

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Catalog(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register the decorated function; ``covers`` lists the survey's rows."""
    def register(build: Callable[[Catalog], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, sql, tuple(covers.split()))
        return build
    return register
