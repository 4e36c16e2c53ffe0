"""Writing results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> str:
    """Truncate and load. With partition columns, rows of a partition are
    brought together first, so each partition gets few files; the rebalance
    splits a partition that is too large for one task."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("overwrite").format(fmt).partitionBy(*partition_by).save(path)
    return path


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """Overwrite only the partitions present in ``df``; repeatable."""
    (df.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).parquet(path))
    return path


def write_clustered(df: DataFrame, path: str, *columns: str) -> str:
    """Sorted into ranges of ``columns``, so that scans can skip row groups."""
    df.repartitionByRange(*[F.col(c) for c in columns]).sortWithinPartitions(*columns).write.mode(
        "overwrite").parquet(path)
    return path


def report_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select for a BI report, with its mixed-case display names."""
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])


def sort_id(value: Column, order: Sequence[str], other: int = 99) -> Column:
    """Display order of a category."""
    chain = F.when(value == order[0], 1)
    for place, label in enumerate(order[1:], start=2):
        chain = chain.when(value == label, place)
    return chain.otherwise(other)
