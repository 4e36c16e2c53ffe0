"""Storage that later work finds in order: buckets for joins, interleaved keys for filters on several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def buckets_for(*tables: DataFrame, rows: int = 500_000, least: int = 8) -> int:
    """Buckets for tables that are to meet, so that none has more than ``rows`` rows a bucket on average: a power of two.

    Rows are counted, which Parquet's footers answer. Spark allows 100,000 buckets.
    """
    most = max(t.count() for t in tables)
    return min(max(least, 1 << max(0, -(-most // rows) - 1).bit_length()), 1 << 16)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store ``df`` in ``buckets`` files by the hash of ``keys``, sorted in each, and name it ``table`` in the catalogue.

    Rows are dealt to the buckets first, so each bucket is one file. Tables with
    equal keys and buckets are joined, and one of them is grouped, without an
    exchange. A bucket is one task, so choose enough of them for the data
    (``buckets_for``), and keys without one hot value.
    """
    dealt = df.repartition(buckets, *[F.col(k) for k in keys])
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, table: str, path: str, schema: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Name stored buckets again in a session (or catalogue) that does not know them."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet CLUSTERED BY ({_names(keys)}) SORTED BY ({_names(keys)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def interleaved(ranks: Sequence[str], bits: int) -> Column:
    """The bits of several columns of small numbers in turn, the highest first, as one number: near in it is near in all."""
    out = F.lit(0).cast("bigint")
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(F.col(rank).cast("bigint"), bit).bitwiseAND(1))
    return out


def with_interleaved_key(df: DataFrame, columns: Sequence[str], bits: int = 8, name: str = "_z") -> DataFrame:
    """``df`` with an interleaved key over columns of any sortable type and any distribution.

    Each column's values are ranked into 2^bits parts of about equal size, by
    quantiles that one aggregate over the table approximates (text and other
    types by its leading characters as a number). NULLs come first.
    """
    if bits * len(columns) > 62:
        raise ValueError("too many bits for one key")
    parts = 1 << bits
    numeric = {c: _as_number(df, c) for c in columns}
    cuts = df.agg(*[F.percentile_approx(v, [k / parts for k in range(1, parts)], 20 * parts).alias(c) for c, v in numeric.items()]).first()
    # a step of its own: each number is asked for at every step of the search
    numbers = {c: f"{name}n{k}" for k, c in enumerate(columns)}
    ranks = {}
    for k, c in enumerate(columns):
        borders = sorted({b for b in cuts[c] or [] if b == b})
        v = F.col(numbers[c])
        ranks[f"{name}{k}"] = F.when(v.isNull(), 0).otherwise(_borders_below(borders, v))
    # a step of its own: each rank is asked for once per bit
    keyed = df.withColumns({numbers[c]: v for c, v in numeric.items()}).withColumns(ranks)
    return keyed.withColumn(name, interleaved(list(ranks), bits)).drop(*ranks, *numbers.values())


def _borders_below(borders: Sequence[float], value: Column) -> Column:
    """How many of the ascending ``borders`` lie below ``value``, by halving."""
    if not borders:
        return F.lit(0)
    marks = F.array(*[F.lit(float(b)) for b in borders])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(borders).bit_length()))])
    # behind the last border there is NULL, which is not below
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(marks, at + step - 1) < value, at + step).otherwise(at))


def _as_number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    value = F.col(column)
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if kind in ("string", "binary"):
        return F.conv(F.rpad(F.substring(F.hex(value.cast("binary")), 1, 12), 12, "0"), 16, 10).cast("double")
    return value.cast("double")


def write_interleaved(df: DataFrame, path: str, columns: Sequence[str], bits: int = 8, files: int | None = None) -> str:
    """Sorted by the interleaved key: a filter on any of ``columns`` skips most row groups, where a plain sort serves the first alone."""
    keyed = with_interleaved_key(df, columns, bits)
    spread = keyed.repartitionByRange(files, "_z", *columns) if files else keyed.repartitionByRange("_z", *columns)
    spread.sortWithinPartitions("_z", *columns).drop("_z").write.mode("overwrite").parquet(path)
    return path
