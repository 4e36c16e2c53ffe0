"""Result columns in plain types, alike in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain(df: DataFrame, *columns: str) -> DataFrame:
    """Select columns; decimals as doubles, integers as bigint, days as text."""
    shown = []
    for c in columns or df.columns:
        kind = df.schema[c].dataType
        value = F.col(f"`{c}`")
        if isinstance(kind, T.DecimalType):
            value = value.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            value = value.cast("bigint")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            value = value.cast("string")
        shown.append(value.alias(c))
    return df.select(*shown)
