"""Surrogate keys that stay unique: a stored dictionary of values and their keys.

A hash modulo 10 million clashes likelier than not from some 3,700 values on.
Here a value keeps the key it once got; a new value gets its hash, and if that
belongs to another value, the hash of the next probe. Old keys never change.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import hash_key
from tidemark.operators.numbering import numbered
from tidemark.session import stored
from tidemark.sources import files

ENTRIES = "value string, key bigint, probe int"
PROBES = 64


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The values known so far, each with its key and the probe that gave it."""
    return spark.read.schema(ENTRIES).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], ENTRIES)


def _probed(value: Column, probe: int, key: Callable[[Column], Column]) -> Column:
    return key(value) if probe == 0 else key(F.concat(value, F.lit(f"␟{probe}")))


def _unknown(spark: SparkSession, path: str, values: DataFrame, column: str) -> DataFrame:
    asked = values.select(F.col(column).cast("string").alias("value")).filter("value is not null").distinct()
    return asked.join(dictionary(spark, path).select("value"), "value", "left_anti")


def add_values(spark: SparkSession, path: str, values: DataFrame, column: str, key: Callable[[Column], Column] = hash_key) -> int:
    """Give the values that the dictionary does not know a key; returns how many there were.

    Round by round the values without a key try their next probe. A key goes to
    one of the values that ask for it, the least, if no value has it; the others
    go on. New entries are appended in one commit. Values already known, NULLs
    and repeated values change nothing. One writer at a time.
    """
    known = dictionary(spark, path).select("key")
    waiting = stored(_unknown(spark, path, values, column))
    given: list[DataFrame] = []
    for probe in range(PROBES):
        if waiting.isEmpty():
            break
        asking = waiting.withColumn("key", _probed(F.col("value"), probe, key).cast("bigint"))
        first = asking.groupBy("key").agg(F.min("value").alias("value")).join(known, "key", "left_anti")
        won = stored(first.select("value", "key", F.lit(probe).alias("probe")))
        given.append(won)
        known = known.unionByName(won.select("key"))
        waiting = stored(waiting.join(won.select("value"), "value", "left_anti"))
    else:
        if not waiting.isEmpty():
            raise ValueError(f"no free key after {PROBES} probes; the key range is too small")
    if not given:
        return 0
    new = given[0]
    for more in given[1:]:
        new = new.unionByName(more)
    new = stored(new)
    new.write.mode("append").parquet(path)
    return new.count()


def add_dense(spark: SparkSession, path: str, values: DataFrame, column: str) -> int:
    """The same with keys 0, 1, 2 … in the order values arrive (those of one call by value), as bitmaps of ids want them."""
    top = dictionary(spark, path).agg(F.coalesce(F.max("key") + 1, F.lit(0)).alias("n")).first().n
    new = numbered(_unknown(spark, path, values, column), "value", name="at").select("value", (F.col("at") + top).alias("key"), F.lit(0).alias("probe"))
    new = stored(new)
    new.write.mode("append").parquet(path)
    return new.count()


def with_dictionary_keys(df: DataFrame, path: str, columns: Sequence[str], unknown: str = "Unknown") -> DataFrame:
    """Add ``<column>_id`` from the dictionary, NULL values as ``unknown``; a value that it lacks has NULL."""
    entries = dictionary(df.sparkSession, path)
    out = df
    for c in columns:
        found = entries.select(F.col("value").alias("_value"), F.col("key").alias(f"{c}_id"))
        out = out.withColumn("_asked", F.coalesce(F.col(c).cast("string"), F.lit(unknown))).join(found, F.col("_asked") == F.col("_value"), "left").drop("_asked", "_value")
    return out


def keyed_dimension(spark: SparkSession, path: str, sources: Sequence[tuple[DataFrame, str]], name: str, unknown: str = "Unknown") -> DataFrame:
    """The distinct values of one attribute over many facts, with keys from the dictionary, which learns new ones."""
    for df, column in sources:
        values = df.select(F.coalesce(F.col(column).cast("string"), F.lit(unknown)).alias(name)).distinct()
        add_values(spark, path, values, name)
    used = sources[0][0].select(F.coalesce(F.col(sources[0][1]).cast("string"), F.lit(unknown)).alias(name)).distinct()
    for df, column in sources[1:]:
        used = used.unionByName(df.select(F.coalesce(F.col(column).cast("string"), F.lit(unknown)).alias(name)).distinct())
    return used.distinct().join(dictionary(spark, path).select(F.col("value").alias(name), F.col("key").alias(f"{name}_id")), name).select(f"{name}_id", name)
