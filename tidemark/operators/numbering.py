"""Numbers for rows in a global order, without bringing the rows together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

ROW_BITS = 33  # monotonically_increasing_id holds the partition above them


def numbered(df: DataFrame, *keys: str | Column, name: str = "at") -> DataFrame:
    """``df`` with each row's place (from 0, without gaps) in the ascending order of ``keys``; nulls come first.

    Rows are sorted into ranges; a row's place is its place in the range and the
    rows of the ranges before it. Only one count per range meets in one task.
    Rows with equal keys lie in one range, so end the keys with what tells rows
    apart. The rows are written to the shared folder on the way.
    """
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
    rows = stored(ranged).withColumn("_part", F.shiftrightunsigned("_row", ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    counts = stored(counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    at = F.col("_before") + F.col("_row").bitwiseAND((1 << ROW_BITS) - 1)
    return rows.join(counts, "_part").withColumn(name, at).drop("_row", "_part", "_before")
