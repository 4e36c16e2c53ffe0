"""Places of rows in a global order, found without bringing the rows together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import offsets, written

ROW_BITS = 33  # monotonically_increasing_id holds the partition above them


def placed(df: DataFrame, *keys: str | Column, name: str = "at") -> DataFrame:
    """``df`` with each row's place (from 0, without gaps) in the ascending order of ``keys``; nulls come first.

    Rows are sorted into ranges; a row's place is its place in the range and the
    rows of the ranges before it. Only one number per range meets in one task.
    Rows with equal keys lie in one range, so end the keys with what tells rows
    apart. The rows are written to the shared folder on the way.
    """
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
    rows = written(ranged, "placed").withColumn("_part", F.shiftrightunsigned("_row", ROW_BITS))
    before = written(offsets(rows.groupBy("_part").agg(F.count("*").alias("_n")), "_part", "_n"), "places")
    at = F.col("_n_before") + F.col("_row").bitwiseAND((1 << ROW_BITS) - 1)
    return rows.join(before, "_part").withColumn(name, at).drop("_row", "_part", "_n_before")
