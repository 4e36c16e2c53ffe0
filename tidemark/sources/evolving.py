"""Stored tables whose schema may grow: a ledger of schemas beside the files.

``<path>.schema`` holds one small text file per version. A batch may bring new
columns, which are appended, and wider types, which replace narrower ones; old
files are left as they are and read with NULLs and widened values. Whatever
would lose or change stored values is refused before anything is written.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import files


class SchemaChange(ValueError):
    """A batch that does not fit the stored table."""


WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def wider(old: T.DataType, new: T.DataType, where: str = "") -> T.DataType:
    """The type that holds all values of both; SchemaChange if there is none that old files can be read with."""
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    kinds = type(old), type(new)
    if all(k in WHOLE for k in kinds):
        return max((old, new), key=lambda t: WHOLE.index(type(t)))
    whole_part = {T.ByteType: 1, T.ShortType: 1, T.IntegerType: 1, T.FloatType: 1}
    if T.DoubleType in kinds and all(k is T.DoubleType or k in whole_part for k in kinds):
        return T.DoubleType()
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        digits = max(old.precision - old.scale, new.precision - new.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    if set(kinds) == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return evolved(old, new, f"{where}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(wider(old.elementType, new.elementType, f"{where}[]"), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType) and old.keyType == new.keyType:
        return T.MapType(old.keyType, wider(old.valueType, new.valueType, f"{where}{{}}"), True)
    raise SchemaChange(f"{where} is {old.simpleString()} and can not become {new.simpleString()}")


def evolved(old: T.StructType, new: T.StructType, where: str = "") -> T.StructType:
    """The old columns, widened where the new ones are wider, then the new ones; names are compared without case."""
    at = {f.name.lower(): f for f in new.fields}
    if len(at) < len(new.fields):
        raise SchemaChange(f"{where or 'the batch'} has two columns of one name: {', '.join(new.names)}")
    fields = [T.StructField(f.name, wider(f.dataType, at[f.name.lower()].dataType, where + f.name) if f.name.lower() in at else f.dataType, True) for f in old.fields]
    known = {f.name.lower() for f in old.fields}
    added = [T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType, True) for f in new.fields if f.name.lower() not in known]
    return T.StructType(fields + added)


def ledger_path(path: str) -> str:
    return f"{path.rstrip('/')}.schema"


def versions(spark: SparkSession, path: str) -> list[tuple[int, T.StructType]]:
    """Every version of the table's schema, oldest first."""
    if not files.exists(spark, ledger_path(path)):
        return []
    rows = spark.read.schema("value string, v int").text(ledger_path(path)).collect()
    return sorted(((r.v, T.StructType.fromJson(json.loads(r.value))) for r in rows), key=lambda x: x[0])


def _shaped(value: Column, kind: T.DataType, target: T.DataType) -> Column:
    """A value in the target's type; fields it lacks are NULL."""
    if isinstance(target, T.StructType) and isinstance(kind, T.StructType):
        at = {f.name.lower(): f for f in kind.fields}
        parts = [(_shaped(value.getField(at[f.name.lower()].name), at[f.name.lower()].dataType, f.dataType) if f.name.lower() in at else F.lit(None).cast(f.dataType)).alias(f.name)
                 for f in target.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(target, T.ArrayType) and isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _shaped(x, kind.elementType, target.elementType))
    return value if kind == target else value.cast(target)


def shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``, in its order and types."""
    at = {f.name.lower(): f for f in df.schema.fields}
    return df.select(*[
        (_shaped(F.col(f"`{at[f.name.lower()].name}`"), at[f.name.lower()].dataType, f.dataType) if f.name.lower() in at else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def agreed_schema(spark: SparkSession, path: str, batch: T.StructType) -> T.StructType:
    """The schema to write a batch with; a version is added to the ledger if it differs from the last.

    Two writers that add a version at once collide on its folder: one fails and
    can try again.
    """
    known = versions(spark, path)
    number, old = known[-1] if known else (0, T.StructType([]))
    schema = evolved(old, batch)
    if schema != old:
        row = spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
        row.write.mode("errorifexists").text(f"{ledger_path(path)}/v={number + 1}")
    return schema


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> T.StructType:
    """Append a batch; new columns are added to the table, wider types widen it. No stored file is touched."""
    schema = agreed_schema(df.sparkSession, path, df.schema)
    shaped(df, schema).write.mode("append").partitionBy(*partition_by).parquet(path)
    return schema


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table by its newest schema, or by an earlier one: columns that a file lacks are NULL."""
    known = versions(spark, path)
    if not known:
        raise SchemaChange(f"{path} has no schema ledger")
    schema = known[-1][1] if version is None else dict(known)[version]
    return spark.read.schema(schema).parquet(path)
