"""Compare two sources that should agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], metrics: Sequence[str],
              threshold: float) -> DataFrame:
    """Sum both by key, put ``b`` beside ``a``, flag differences over the threshold (percent)."""
    left = a.groupBy(*keys).agg(*[F.sum(m).alias(f"{m}_a") for m in metrics])
    right = b.groupBy(*keys).agg(*[F.sum(m).alias(f"{m}_b") for m in metrics])
    joined = left.join(right, list(keys), "left")
    for m in metrics:
        difference = F.coalesce(F.col(f"{m}_b"), F.lit(0)) - F.col(f"{m}_a")
        joined = joined.withColumn(f"{m}_diff_pct", ratio(difference * 100, F.col(f"{m}_a"), 4))
        joined = joined.withColumn(
            f"{m}_flag", F.when(F.abs(F.col(f"{m}_diff_pct")) > threshold, "CHECK").otherwise("OK"))
    return joined


def coverage(expected: DataFrame, facts: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """Every expected id with its totals, zero where the facts have none.

    Facts are summed before the join, so a busy id brings one row to it.
    """
    totals = facts.groupBy(key).agg(*[F.sum(m).alias(m) for m in metrics])
    return expected.select(key).distinct().join(totals, key, "left").select(
        key, *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in metrics])


def both_ways_difference(a: DataFrame, b: DataFrame, name_a: str, name_b: str) -> DataFrame:
    """Rows only one side has (with multiplicity), and which side."""
    b = b.select(*a.columns)
    return a.exceptAll(b).withColumn("only_in", F.lit(name_a)).unionByName(
        b.exceptAll(a).withColumn("only_in", F.lit(name_b)))
