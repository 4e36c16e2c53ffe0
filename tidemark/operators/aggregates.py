"""Grouping: labelled cubes, distinct counts, pivots, allocation."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _subsets(names: Sequence[str]) -> list[list[str]]:
    return [list(c) for size in range(len(names), -1, -1) for c in combinations(names, size)]


def grouping_label(prefix: str, dims: dict[str, str]) -> Column:
    """'WEEK-GEO' plus the code of every retained dimension."""
    return F.concat(
        F.lit(prefix),
        *[F.when(F.grouping(c) == 0, F.lit(f"-{code}")).otherwise(F.lit("")) for c, code in dims.items()],
    )


def labeled_cube(df: DataFrame, fixed: Sequence[str], dims: dict[str, str], measures: Sequence[Column],
                 prefix: str, label: str = "aggregated_by") -> DataFrame:
    """CUBE of ``dims`` within ``fixed``, with a label of the retained ones.

    The label tells a rolled-up NULL from a NULL in the data. One scan, one
    Expand, one shuffle with map-side combine. The sets list the cube alone,
    so no set drops a fixed column and nothing has to be filtered away.
    """
    sets = [[F.col(c) for c in [*fixed, *kept]] for kept in _subsets(list(dims))]
    columns = [F.col(c) for c in [*fixed, *dims]]
    return df.groupingSets(sets, *columns).agg(*measures, grouping_label(prefix, dims).alias(label))


def distinct_cube(df: DataFrame, fixed: Sequence[str], dims: dict[str, str],
                  counts: dict[str, tuple[str, Column]], prefix: str,
                  label: str = "aggregated_by") -> DataFrame:
    """Several conditional distinct counts over a labelled cube.

    ``counts`` maps a name to (id column, condition): COUNT(DISTINCT id WHERE
    condition). Rows first become one per (dims, id) with a 0/1 flag per count;
    ids are expanded to the cube cells once, flags reduced per (cell, id), then
    summed per cell. Every step combines before its shuffle, and no count needs
    an Expand of its own.
    """
    ids = list(dict.fromkeys(id_column for id_column, _ in counts.values()))
    flags = {name: F.when(cond, 1).otherwise(0) for name, (_, cond) in counts.items()}
    entries = F.explode(F.array(*[
        F.struct(
            F.lit(i).alias("_kind"), F.col(id_column).cast("string").alias("_id"),
            *[(flags[n] if counts[n][0] == id_column else F.lit(0)).alias(n) for n in counts],
        )
        for i, id_column in enumerate(ids)
    ]))
    per_row = df.select(*fixed, *dims, entries.alias("_e")).select(*fixed, *dims, "_e.*")
    per_row = per_row.filter(F.col("_id").isNotNull())
    keys = [*fixed, *dims]
    per_id = per_row.groupBy(*keys, "_kind", "_id").agg(*[F.max(n).alias(n) for n in counts])

    sets = [[F.col(c) for c in [*fixed, *kept, "_kind", "_id"]] for kept in _subsets(list(dims))]
    per_cell_id = per_id.groupingSets(sets, *[F.col(c) for c in [*keys, "_kind", "_id"]]).agg(
        *[F.max(n).alias(n) for n in counts], grouping_label(prefix, dims).alias(label))
    return per_cell_id.groupBy(*keys, label).agg(*[F.sum(n).alias(n) for n in counts])


def with_total(df: DataFrame, total: DataFrame, label: str, text: str) -> DataFrame:
    """Append a coarser total row set under its own label."""
    return df.unionByName(total.withColumn(label, F.lit(text)), allowMissingColumns=True)


def pivot_sum(df: DataFrame, keys: Sequence[str], by: str, value: Column, columns: dict[str, str]) -> DataFrame:
    """Rows to columns by a coded value, summed; the codes are known beforehand.

    Written as conditional sums: one aggregation, no extra pass for the codes.
    """
    sums = [F.sum(F.when(F.col(by) == code, value)).alias(name) for code, name in columns.items()]
    return df.groupBy(*keys).agg(*sums)


def allocate_equally(df: DataFrame, totals: DataFrame, keys: Sequence[str], total: str, name: str) -> DataFrame:
    """Spread each group's total evenly over the group's rows.

    Row counts are aggregated and joined back rather than taken with a window,
    which would bring a whole group to one task.
    """
    shares = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        .join(totals.select(*keys, F.col(total).alias("_total")), list(keys), "left")
        .withColumn(name, F.col("_total").cast("double") / F.col("_rows"))
        .select(*keys, name)
    )
    return df.join(shares, list(keys), "left")


def first_use_lag(df: DataFrame, user_keys: Sequence[str], group_keys: Sequence[str],
                  granted: str, used: str, name: str) -> DataFrame:
    """Average days from grant to first use, over the users of each group."""
    first = df.groupBy(*user_keys, *[k for k in group_keys if k not in user_keys], granted).agg(
        F.min(used).alias("_first"))
    return first.groupBy(*group_keys).agg(F.avg(F.datediff("_first", granted)).alias(name))


def distinct_sorted(column: str) -> Column:
    """The distinct non-NULL values as a sorted array; for small domains."""
    return F.array_sort(F.collect_set(column))
