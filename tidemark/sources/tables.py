"""Tables by name: a folder of parquet tables or the session's own catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import prepare


class Catalog:
    """Names resolve to ``<folder>/<name>.parquet``, or to a registered path.

    ``Catalog(spark, folder).orders`` is a lazy scan; pruning and pushdown are
    left to Catalyst.
    """

    def __init__(self, spark: SparkSession, folder: str, paths: dict[str, str] | None = None):
        self.spark = prepare(spark)
        self.folder = folder.rstrip("/")
        self.paths = dict(paths or {})
        self._scans: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._scans:
            path = self.paths.get(name, f"{self.folder}/{name}.parquet")
            self._scans[name] = self.spark.read.parquet(path)
        return self._scans[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)
