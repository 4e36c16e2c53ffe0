"""Updates and deletes in stored, partitioned tables: only partitions that change are written.

Beside a table at ``path`` lie small tables with one row per partition: ``.gaps``
(how many NULLs its columns have) and ``.days`` (its first and last day). They
decide which partitions an update has to look at, so that the others are
neither read nor written. A list of partitions is no longer than the list of
folders that any scan of the table holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_by
from tidemark.session import stored
from tidemark.sources import files
from tidemark.sources.sinks import replace_partitions


def _of(df: DataFrame, partition: str, values: Sequence) -> DataFrame:
    """The rows of some partitions: a constant filter, so other folders are not even listed."""
    known = [v for v in values if v is not None]
    wanted = F.col(partition).isin(known) if known else F.lit(False)
    return df.filter(wanted | F.col(partition).isNull() if len(known) < len(values) else wanted)


def _values(df: DataFrame, partition: str) -> list:
    return sorted((r[0] for r in df.select(partition).distinct().collect()), key=lambda v: (v is None, v))


# ---- filling NULLs -----------------------------------------------------------


def gaps_path(path: str) -> str:
    return f"{path.rstrip('/')}.gaps"


def record_gaps(spark: SparkSession, path: str, partition: str, columns: Sequence[str], only: Sequence | None = None) -> None:
    """Count the NULLs of ``columns`` per partition, of all or of ``only`` some, into the manifest."""
    table = spark.read.parquet(path).select(partition, *columns)
    table = table if only is None else _of(table, partition, only)
    nulls = [F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns]
    replace_partitions(table.groupBy(partition).agg(F.count(F.lit(1)).alias("rows"), *nulls), gaps_path(path), [partition])


def write_with_gaps(df: DataFrame, path: str, partition: str, columns: Sequence[str]) -> None:
    """Write the partitions present in ``df``, and what NULLs they have."""
    df = stored(df)
    replace_partitions(df, path, [partition])
    record_gaps(df.sparkSession, path, partition, columns, _values(df, partition))


def backfill_stored(spark: SparkSession, path: str, source: DataFrame, target_key: Column, source_key: str, columns: Sequence[str],
                    partition: str, newest: str | None = None, *tiebreak: str) -> list:
    """Fill the NULLs of ``columns`` in the stored table from the source row with the key.

    Only values that are NULL are filled. Of the source the ``newest`` row per
    key counts (without it the source must have one row per key); NULL keys
    match nothing. The manifest names the partitions that have NULLs at all;
    those are searched for rows that the source can fill, and only partitions
    with such a row are rewritten, each as a whole, in one commit. Returns the
    rewritten partitions: none if run again. Without a manifest one is made.
    """
    if not files.exists(spark, gaps_path(path)):
        record_gaps(spark, path, partition, columns)
    gaps = spark.read.parquet(gaps_path(path))
    some = F.lit(False)
    for c in columns:
        some = some | (F.col(c) > 0)
    candidates = _values(gaps.filter(some), partition)
    if not candidates:
        return []

    source = latest_by(source, [source_key], newest, *tiebreak) if newest else source
    fill = source.filter(F.col(source_key).isNotNull()).select(
        F.col(source_key).cast("string").alias("_sk"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    fill = stored(fill)
    target = spark.read.parquet(path)
    keyed = _of(target, partition, candidates).withColumn("_tk", target_key.cast("string"))
    fillable = F.lit(False)
    for c in columns:
        fillable = fillable | (F.col(c).isNull() & F.col(f"_new_{c}").isNotNull())
    gap = F.lit(False)
    for c in columns:
        gap = gap | F.col(c).isNull()
    hits = keyed.filter(gap).join(fill, F.col("_tk") == F.col("_sk")).filter(fillable)
    changed = _values(hits, partition)
    if not changed:
        return []

    joined = _of(keyed, partition, changed).join(fill, F.col("_tk") == F.col("_sk"), "left")
    filled = joined.select(*[F.coalesce(F.col(c), F.col(f"_new_{c}")).alias(c) if c in columns else F.col(c) for c in target.columns])
    # a table can not be read while it is overwritten
    replace_partitions(stored(filled), path, [partition])
    record_gaps(spark, path, partition, columns, changed)
    return changed


# ---- retention ---------------------------------------------------------------


def days_path(path: str) -> str:
    return f"{path.rstrip('/')}.days"


def record_days(spark: SparkSession, path: str, partition: str, day: str, only: Sequence | None = None) -> None:
    """First and last day and the number of rows of each partition, of all or of ``only`` some, into the catalogue."""
    table = spark.read.parquet(path).select(partition, day)
    table = table if only is None else _of(table, partition, only)
    found = table.groupBy(partition).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("rows"),
                                         F.count(F.when(F.col(day).isNull(), 1)).alias("undated"))
    replace_partitions(found, days_path(path), [partition])


def write_dated(df: DataFrame, path: str, partition: str, day: str) -> None:
    """Write the partitions present in ``df``, and which days they hold."""
    df = stored(df)
    replace_partitions(df, path, [partition])
    record_days(df.sparkSession, path, partition, day, _values(df, partition))


def drop_before(spark: SparkSession, path: str, partition: str, day: str, cutoff: str) -> tuple[list, list]:
    """Delete the rows before ``cutoff`` from the stored table; returns the partitions deleted and rewritten.

    Partitions that end before the cut-off go as folders, unread; one that it
    falls into is rewritten without its older rows; all others stay as they are.
    Rows without a day are kept. The catalogue is changed last, so an
    interrupted run is simply run again; a second run finds nothing to do.
    """
    catalogue = spark.read.parquet(days_path(path))
    limit = F.lit(cutoff).cast("date")
    old = (F.col("last_day").cast("date") < limit) & (F.col("undated") == 0)
    gone = _values(catalogue.filter(old), partition)
    tail = _values(catalogue.filter(~F.coalesce(old, F.lit(False)) & (F.col("first_day").cast("date") < limit)), partition)
    if tail:
        kept = _of(spark.read.parquet(path), partition, tail).filter(F.col(day).isNull() | (F.col(day).cast("date") >= limit))
        replace_partitions(stored(kept), path, [partition])
        record_days(spark, path, partition, day, tail)
    for value in gone:
        files.remove(spark, files.partition_path(path, **{partition: value}))
        files.remove(spark, files.partition_path(days_path(path), **{partition: value}))
    return gone, tail
