"""Semi-structured columns: JSON landed once as VARIANT, its keys and types found on the way."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# names may hold anything between back-ticks; OBJECT outside them is Spark's word for a record
_OUTSIDE = re.compile(r"(`(?:[^`]|``)*`)|OBJECT<")


def record_type(shape: str | None) -> T.StructType:
    """The text that ``schema_of_variant_agg`` gives for records, as a type."""
    if not shape or not shape.startswith("OBJECT<"):
        return T.StructType([])
    return T.DataType.fromDDL(_OUTSIDE.sub(lambda m: m.group(1) or "STRUCT<", shape))


def land_variant(df: DataFrame, json: str, path: str, record: str = "record") -> tuple[T.StructType, int, int]:
    """Write ``df`` with its JSON text as a VARIANT column ``record``; returns the records' type, rows, and rows that are no JSON.

    One pass: the keys and types are an aggregate that Spark observes while the
    rows are written. Types that differ between rows widen to one that holds
    both, or stay VARIANT. Text that is no JSON becomes NULL and is counted.
    """
    seen = Observation("landed")
    parsed = df.withColumn(record, F.try_parse_json(json))
    bad = F.count(F.when(F.col(record).isNull() & F.col(json).isNotNull(), 1)).alias("bad")
    watched = parsed.observe(seen, F.schema_of_variant_agg(record).alias("shape"), F.count(F.lit(1)).alias("rows"), bad)
    watched.select(*[c for c in df.columns if c != json], record).write.parquet(path)
    found = seen.get
    return record_type(found["shape"]), found["rows"], found["bad"]


def _ddl(kind: T.DataType) -> str:
    """A type as text, with names of any kind."""
    if isinstance(kind, T.StructType):
        return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:{_ddl(f.dataType)}" for f in kind.fields) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    return kind.simpleString()


def _value(record: str, names: Sequence[str], kind: str) -> Column:
    """What stands under a path of names, NULL where that is missing or of another kind."""
    value, path = F.col(record), "$"
    for name in names:
        if "'" not in name:
            path += f"['{name}']"
        elif '"' not in name:
            path += f'["{name}"]'
        else:  # no way to write it in a path
            value, path = F.try_variant_get(value, path, "map<string,variant>")[name], "$"
    return F.try_variant_get(value, path, kind)


def variant_columns(df: DataFrame, record: str, kind: T.StructType, known: Sequence[str] = (), as_text: bool = False) -> DataFrame:
    """One column per key of the records, ``known`` ones first and the others by name; a row without the key has NULL.

    Values have the type found for their key; with ``as_text`` they are text
    (records and lists as JSON).
    """
    types = {f.name: f.dataType for f in kind.fields}
    names = [*known, *sorted(n for n in types if n not in known)]

    def value(name: str) -> Column:
        found = types.get(name, T.StringType())
        simple = as_text or isinstance(found, T.NullType)
        return _value(record, [name], "string" if simple else _ddl(found))

    return df.select(*[c for c in df.columns if c != record], *[value(n).alias(n) for n in names])


def leaf_columns(df: DataFrame, record: str, kind: T.StructType) -> DataFrame:
    """Every leaf of nested records as a column: names joined by '_' (dots, colons and dashes become '_'), lists kept, empty ones NULL, scalars as text."""
    def leaves(kind: T.StructType, above: tuple[str, ...]) -> list[Column]:
        out: list[Column] = []
        for f in kind.fields:
            here = (*above, f.name)
            label = "_".join(here).translate(str.maketrans(".:-", "___"))
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, here)
            elif isinstance(f.dataType, T.ArrayType):
                items = _value(record, here, _ddl(f.dataType))
                out.append(F.when(F.size(items) > 0, items).alias(label))
            else:
                out.append(_value(record, here, "string").alias(label))
        return out

    return df.select(*[c for c in df.columns if c != record], *leaves(kind, ()))


def landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
