"""Pick one (or the tied) row per key.

Rank filters compile to a WindowGroupLimit: every map task keeps only its own
best rows per key before the shuffle, so a key that holds a third of the table
does not travel to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", rank.over(window)).filter(F.col("_rank") == 1).drop("_rank")


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order`` (end it with a unique column)."""
    return _ranked(df, keys, order, F.row_number())


def latest_by(df: DataFrame, keys: Sequence[str], newest: str, *tiebreak: str) -> DataFrame:
    """One row per key: the newest, NULL times last, ties by ``tiebreak`` descending."""
    order = [F.col(c).desc_nulls_last() for c in (newest, *tiebreak)]
    return first_by(df, keys, order)


def latest_ties(df: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """All rows that share their key's newest time (NULL only if all are NULL).

    The ties themselves may be many, so the newest time per key is aggregated
    first and joined back: the join may split a hot key, a window may not.
    """
    top = df.groupBy(*keys).agg(F.max(newest).alias("_newest"))
    top = top.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_newest")
    on = df[newest].eqNullSafe(top["_newest"])
    for k in keys:
        on = on & df[k].eqNullSafe(top[f"_k_{k}"])
    return df.join(top, on, "left_semi")


def place_in_group(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group 0, 1, 2 … by ``order`` (unique in the group).

    Rows are sorted into pieces of about equal size; a row's place is its place
    in the piece and the group's rows in the pieces before, so a large group is
    numbered by many tasks. Groups with a NULL column drop out.
    """
    pieces = stored(df.repartitionByRange(*groups, *order).withColumn("_piece", F.spark_partition_id()))
    inside = Window.partitionBy("_piece", *groups).orderBy(*order)
    before = Window.partitionBy(*groups).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("_piece", *groups).agg(F.count(F.lit(1)).alias("_rows"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    return (
        pieces.withColumn("_inside", F.row_number().over(inside) - 1).join(counts, ["_piece", *groups])
        .withColumn(name, F.col("_inside") + F.col("_before")).drop("_piece", "_inside", "_before")
    )


def one_per_key(df: DataFrame, keys: Sequence[str], *tiebreak: str) -> DataFrame:
    """Any one row per key, made repeatable by an explicit tiebreak."""
    return first_by(df, keys, [F.col(c).asc_nulls_last() for c in tiebreak])


def day_ordinal(df: DataFrame, keys: Sequence[str], day: str, name: str) -> DataFrame:
    """Number a key's days 1, 2, 3 … (a dense rank of the day).

    The window runs over the distinct (key, day) pairs, which are bounded by
    the days of the history however many rows a key has.
    """
    days = df.select(*keys, day).distinct()
    window = Window.partitionBy(*keys).orderBy(day)
    numbered = days.withColumn(name, F.dense_rank().over(window)).select(
        *[F.col(k).alias(f"_k_{k}") for k in (*keys, day)], name
    )
    on = None
    for k in (*keys, day):
        same = df[k].eqNullSafe(numbered[f"_k_{k}"])
        on = same if on is None else on & same
    return df.join(numbered, on, "left").drop(*[f"_k_{k}" for k in (*keys, day)])
